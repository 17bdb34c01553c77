"""Surrogates for personal data, in native expressions.

Entities are found by one pattern: mail addresses, phone numbers, card numbers,
IP addresses, account numbers (IBAN), secrets (keys and tokens), and persons' names
after a title. Phone numbers are recognised with ``+`` and country code; without, with a
bracketed area code ((415) 555-2671), in groups of 3-3-4 (415-555-2671), or after a trunk 0
(030 1234567, 01 23 45 67 89); groups part at blanks, hyphens or dots, after a trunk 0 also
at a slash. National numbers written as one run of digits are not recognised. Each distinct entity of a kind gets a surrogate made from a keyed hash:

* of its kind and format: digits for digits, letters for letters of the same script
  and case, punctuation, prefixes and lengths as they were; a card keeps its first digit,
  a phone number its country code, an address its numbers within range;
* names are made of syllables of their script, given names by the title's gender, with
  the ending that goes with it;
* equal entities get equal surrogates in all documents, whatever their format or case;
  a person's later bare name in the same document follows (coreference).

Surrogates are checked against each other and against all entities of the corpus: of
those that collide all but one try again, until all are distinct; where a format has fewer
surrogates than entities, digits are added. This works on the
table of distinct entities, so a hot entity is one row.

Cases: null texts stay null, texts without entities stay as they are; a text that is
all one entity is replaced; repeated rows get equal texts; entities that share no
canonical form have different surrogates; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import text_key
from corpusqa.sources.shared import written

# -- fixed values ------------------------------------------------------------------

MALE_TITLES = ["mr", "herr", "herrn", "señor", "sr", "monsieur", "don", "sir", "господин"]
FEMALE_TITLES = ["mrs", "ms", "miss", "frau", "señora", "sra", "madame", "mme", "mlle", "doña", "госпожа"]
OTHER_TITLES = ["dr", "prof", "доктор"]
LATIN_SYLLABLES = ["ba", "de", "fi", "ga", "jo", "ka", "le", "mi", "no", "pe", "ra", "se", "ti", "vo", "wi", "za"]
CYRILLIC_SYLLABLES = ["ба", "де", "фи", "га", "жо", "ка", "ле", "ми", "но", "пе", "ра", "се", "ти", "во", "ви", "за"]
LATIN_ENDINGS = {"m": "n", "f": "la", "x": "r"}
CYRILLIC_ENDINGS = {"m": "н", "f": "ла", "x": "р"}

#: Country calling codes of one and two digits; all others have three.
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

# -- end of fixed values -------------------------------------------------------------

_TITLES = MALE_TITLES + FEMALE_TITLES + OTHER_TITLES
# a small "miss" is a verb
_TITLE = "(?!miss )(?i:" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")\.?"
_NAME = r"\p{Lu}[\p{L}'’]+"
#: Phone numbers: with a country code and dots (eight digits or more, so no decimal fraction), with a country
#: code, with a bracketed area code, in groups of 3-3-4, after a trunk 0, and after a trunk 0 in pairs.
PHONES = [
    r"(?=\+[0-9() -]*\.[0-9(])(?=\+(?:[ .()-]{0,2}[0-9]){8})\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,8}){1,4}(?![0-9]|[.-][0-9])",
    r"(?:\+[0-9]{1,3}[ -]?)(?:\([0-9]{1,4}\)[ -]?)?[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,4}(?![0-9])",
    r"\([0-9]{2,5}\)[ .-]?(?:[0-9]{3,4}[ .-]?[0-9]{4}|[0-9]{5,8}|[0-9]{2,4}(?:[ .-][0-9]{2,4}){2,3})(?![0-9]|[.-][0-9])",
    r"(?<![.-])(?:1[ .-])?[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3}[ -])[0-9]{4}(?![0-9]|[.-][0-9])",
    r"(?<![.-])(?=0(?:[ ./-]?[0-9]){7,12}(?![0-9]|[ ./-][0-9]))0[1-9][0-9]{1,4}(?:[ ./-][0-9]{2,8}){1,4}(?![0-9]|[./-][0-9])",
    r"(?<![.-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9]|[.-][0-9])",
]
#: The kinds in order of precedence, and what they look like.
KINDS = [
    ("email", r"[\p{L}\p{N}_][\p{L}\p{N}._+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]+)+"),
    ("secret", r"(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:sk|pk|ghp|xox[bp])[-_][A-Za-z0-9_-]{16,}|AKIA[A-Z0-9]{16})(?![\p{L}\p{N}_])"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("ip", r"(?<![.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    ("card", r"(?<!-)[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9-])"),
    ("phone", "|".join(f"(?:{p})" for p in PHONES)),
    ("ssn", r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("name", rf"{_TITLE} {_NAME}(?: {_NAME})?"),
]
#: No entity begins inside a word.
PATTERN = r"(?<![\p{L}\p{N}_])(?:" + "|".join(f"(?:{p})" for _, p in KINDS) + ")"
#: Tries after which surrogates of one format get longer.
ROUNDS = 16


def _kind(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS):
        out = F.when(entity.rlike(rf"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _parts(kind: Column, entity: Column) -> Column:
    """What of an entity is replaced: a name's words with their roles, or the whole."""
    words = F.split(entity, " ")
    title = F.lower(F.regexp_replace(words[0], r"\.$", ""))
    gender = F.when(title.isin(MALE_TITLES), "m").when(title.isin(FEMALE_TITLES), "f").otherwise("x")
    given = F.when(F.size(words) > 2, F.array(_part(F.concat(F.lit("given-"), gender), words[1]))).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))
    names = F.concat(given, F.array(_part(F.lit("family"), F.element_at(words, -1))))
    return F.when(kind == "name", names).otherwise(F.array(_part(kind, entity)))


def _part(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"))


def canonical(kind: Column, value: Column) -> Column:
    """One form for all spellings of an entity."""
    bare = F.upper(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    bare = F.when((kind == "phone") & value.startswith("+"), F.concat(F.lit("+"), bare)).otherwise(bare)
    return F.when(kind.isin("card", "phone", "ssn", "iban"), bare).otherwise(F.lower(value))


def _digits(seed: Column, places: int) -> Column:
    """Decimal digits of a hash, ``places`` of them (up to 60)."""
    runs = [F.lpad((F.conv(F.substring(seed, 1 + 13 * i, 13), 16, 10).cast("bigint") % 10**12).cast("string"), 12, "0") for i in range(-(-places // 12))]
    return F.substring(F.concat(*runs), 1, places)


def _letters_for(value: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters of the same case; other characters stay."""
    both = F.array(F.struct(F.split(value, "").alias("c"), F.concat(seed, F.sha2(seed, 256)).alias("s")))

    def put(b: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            n = F.conv(F.substring(b["s"], i % 120 + 1, 4), 16, 10).cast("int")
            letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1))
            return (
                F.when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
                .when(c.rlike(r"^\p{Lu}$"), F.upper(letter)).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)
            )
        return F.array_join(F.transform(b["c"], one), "")

    return F.transform(both, put)[0]


def _hex_for(value: Column, seed: Column) -> Column:
    """As many hexadecimal digits; other characters as letters are."""
    long = F.concat(seed, F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("2")), 256), F.sha2(F.concat(seed, F.lit("3")), 256))
    return F.when(value.rlike("^[0-9a-f]+$") & (F.length(value) <= 256), F.substring(long, F.lit(1), F.length(value))).otherwise(_letters_for(value, seed))


def _name_for(kind: Column, value: Column, seed: Column) -> Column:
    """Syllables of the name's script, and its gender's ending; a longer name each eighth try."""
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    count = F.conv(F.substring(seed, 60, 1), 16, 10).cast("int") % 2 + 2 + F.expr("cast(attempt div 8 as int)")
    picks = F.transform(
        F.sequence(F.lit(1), F.least(count, F.lit(50))),
        lambda i: F.conv(F.substring(seed, i, F.lit(1)), 16, 10).cast("int") + 1,
    )

    def spelled(syllables: list[str], endings: dict[str, str]) -> Column:
        table = F.array(*[F.lit(s) for s in syllables])
        end = F.when(kind == "given-m", endings["m"]).when(kind == "given-f", endings["f"]).otherwise(endings["x"])
        return F.concat(F.array_join(F.transform(picks, lambda i: F.element_at(table, i)), ""), end)

    return F.when(cyrillic, spelled(CYRILLIC_SYLLABLES, CYRILLIC_ENDINGS)).otherwise(spelled(LATIN_SYLLABLES, LATIN_ENDINGS))


def _address_for(value: Column, seed: Column) -> Column:
    """Four numbers up to 255, by hash; each has its own byte."""
    byte = [F.conv(F.substring(seed, 1 + 2 * i, 2), 16, 10) for i in range(4)]
    return F.concat_ws(".", *byte)


def _phone_for(form: Column, seed: Column) -> Column:
    """Other digits after a country's code, or after the first digit of a national number."""
    kept = F.regexp_extract(form, rf"^\+({CALLING_CODES}|[0-9]{{3}})", 1)
    kept = F.when(form.startswith("+"), kept).otherwise(F.substring(form, 1, 1))
    left = F.length(F.replace(form, F.lit("+"), F.lit(""))) - F.length(kept)
    return F.concat(kept, F.substring(_digits(seed, 24), F.lit(1), left))


def _longer(kind: Column, made: Column, seed: Column, digits: int) -> Column:
    """A surrogate with digits more, for formats with more entities than surrogates; names grow by themselves."""
    more = F.substring(_digits(seed, 60), 60 - min(digits, 36), min(digits, 36))
    return F.when(kind.startswith("given") | (kind == "family"), made).when(kind == "email", F.concat(more, made)).otherwise(F.concat(made, more))


def _surrogate(kind: Column, form: Column, seed: Column) -> Column:
    number = F.length(form)
    mail = F.concat(_letters_for(F.regexp_extract(form, r"^(.*)\.", 1), seed), F.regexp_extract(form, r"(\.[^.]*)$", 1))
    return (
        F.when(kind == "email", mail)
        .when(kind == "secret", _hex_for(form, seed))
        .when(kind == "iban", F.concat(F.substring(form, 1, 2), F.upper(_letters_for(F.substring(form, F.lit(3), number), seed))))
        .when(kind == "ip", _address_for(form, seed))
        .when(kind == "card", F.concat(F.substring(form, 1, 1), F.substring(_digits(seed, 24), F.lit(1), number - 1)))
        .when(kind == "phone", _phone_for(form, seed))
        .when(kind == "ssn", F.substring(_digits(seed, 24), F.lit(1), number))
        .otherwise(_name_for(kind, form, seed))
    )


def surrogates(found: DataFrame, secret: str) -> DataFrame:
    """``kind, form, surrogate`` for each distinct ``kind, form`` of ``found``, all distinct within a kind and unlike any form."""
    todo = written(found.select("kind", "form").distinct(), "entities")
    # names of all roles share one space
    space = F.when(F.col("kind").startswith("given") | (F.col("kind") == "family"), "name").otherwise(F.col("kind"))
    # a phone number's form has a plus sign that its surrogate, which is put into the number's format, has not
    bare = F.when(space == "phone", F.replace("form", F.lit("+"), F.lit(""))).otherwise(F.col("form"))
    taken = written(todo.select(space.alias("space"), bare.alias("made")).distinct(), "taken")
    done, attempt = None, 0
    while True:
        seed = F.sha2(F.concat_ws("|", F.lit(secret), space, "form", F.lit(str(attempt))), 256)
        new = _surrogate(F.col("kind"), F.col("form"), seed)
        if attempt >= ROUNDS:
            new = _longer(F.col("kind"), new, seed, attempt // ROUNDS)
        made = todo.withColumn("attempt", F.lit(attempt)).select("kind", "form", space.alias("space"), new.alias("made"))
        first = made.groupBy("space", "made").agg(F.min(F.struct("form", "kind")).alias("one")).join(taken, ["space", "made"], "left_anti")
        won = written(first.select("one.kind", "one.form", "space", "made"), "surrogates")
        done = won if done is None else done.unionByName(won)
        todo = written(todo.join(won, ["kind", "form"], "left_anti"), "entities")
        if todo.isEmpty():
            return done.select("kind", "form", F.col("made").alias("surrogate"))
        attempt += 1
        taken = taken.unionByName(won.select("space", "made"))


def _formatted(kind: Column, value: Column, surrogate: Column) -> Column:
    """A surrogate in the format of the entity it stands for."""
    gaps = F.split(value, "[A-Za-z0-9]", -1)
    filled = F.array_join(F.zip_with(gaps, F.split(surrogate, ""), lambda g, c: F.concat(F.coalesce(g, F.lit("")), F.coalesce(c, F.lit("")))), "")
    upper = (F.upper(value) == value) & (F.lower(value) != value)
    cased = F.when(upper, F.upper(surrogate)).otherwise(surrogate)
    named = F.when(upper & (F.length(value) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(kind.isin("card", "phone", "ssn", "iban"), filled).when(kind.isin("email", "secret", "ip"), cased).otherwise(named)


def pseudonymised(docs: DataFrame, secret: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_entities, text`` for each row; ``secret`` keys the surrogates."""
    texts = docs.select(text_key(text).alias("key"), F.col(text).alias("t"))
    entity = F.explode(F.transform(F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0)), lambda e, i: F.struct(i.alias("at"), e.alias("entity"))))
    spotted = texts.select("key", entity.alias("e")).select("key", "e.*").withColumn("type", _kind(F.col("entity")))
    parts = spotted.select("key", "at", "entity", F.posexplode(_parts(F.col("type"), F.col("entity"))).alias("nth", "p")).select(
        "key", "at", "entity", "nth", "p.kind", "p.value", canonical(F.col("p.kind"), F.col("p.value")).alias("form")
    )
    # copies of a text have the same entities at the same places
    parts = written(parts.groupBy("key", "at", "nth").agg(*[F.first(c).alias(c) for c in ("entity", "kind", "value", "form")]), "spotted")
    made = parts.join(surrogates(parts, secret), ["kind", "form"])
    new = _formatted(F.col("kind"), F.col("value"), F.col("surrogate"))
    words = made.select("key", "at", "nth", "entity", "kind", "value", new.alias("new"))
    whole = words.groupBy("key", "at").agg(
        F.first("entity").alias("entity"), F.first("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("nth", "new"))).alias("w"),
        F.array_sort(F.collect_list(F.struct("value", "new"))).alias("names"),
    )
    title = F.concat(F.substring_index("entity", " ", 1), F.lit(" "))
    is_name = F.col("kind").startswith("given") | (F.col("kind") == "family")
    joined = F.array_join("w.new", " ")
    replaced = F.when(is_name, F.concat(title, joined)).otherwise(joined)
    by_text = whole.select("key", "at", replaced.alias("new"), F.when(is_name, F.col("names")).alias("names")).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"), F.array_distinct(F.flatten(F.collect_list("names"))).alias("names")
    )
    # written, so that a text which very many rows share is a join which is split; and merged at
    # every size, as a broadcast of few texts' surrogates would be another plan than that of many
    by_text = written(by_text, "surrogates_by_text").hint("merge")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), text_key(text).alias("key")).join(by_text, "key", "left")
    gaps = F.split("t", PATTERN, -1)

    def renamed(body: Column, name: Column) -> Column:
        return F.regexp_replace(body, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), name["value"], F.lit(r"(?![\p{L}\p{N}])")), name["new"])

    # bare names stand between the entities only
    gaps = F.when(F.size("names") > 0, F.transform(gaps, lambda g: F.aggregate("names", g, renamed))).otherwise(gaps)
    out = F.array_join(F.zip_with(gaps, F.col("new"), lambda g, n: F.concat(g, F.coalesce(n["new"], F.lit("")))), "")
    return rows.select(
        "doc_id", F.when(F.col("new").isNull(), 0).otherwise(F.size("new")).cast("bigint").alias("n_entities"),
        F.when(F.col("new").isNull(), F.col("t")).otherwise(out).alias("text"),
    )
