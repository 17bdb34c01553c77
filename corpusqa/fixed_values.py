"""Fixed values.

Everything in this module is data that has to be spelled exactly so for results
to come out right: file extensions, prompt wording, prices, limits, layout
marks. No logic lives here.
"""

# -- fixed values: files ----------------------------------------------------

DOCUMENT_EXTENSIONS = [".pdf", ".txt", ".docx", ".json", ".csv", ".xlsx", ".xls"]

EXTENSION_LANGUAGES = {
    ".py": "python",
    ".java": "java",
    ".kt": "kotlin",
    ".js": "js",
    ".ts": "ts",
    ".php": "php",
    ".proto": "proto",
    ".cpp": "cpp",
    ".c": "c",
    ".rb": "ruby",
    ".rs": "rust",
    ".scala": "scala",
    ".swift": "swift",
    ".md": "markdown",
    ".tex": "latex",
    ".html": "html",
    ".sol": "sol",
    ".cs": "csharp",
    ".cbl": "cobol",
    ".lua": "lua",
    ".pl": "perl",
    ".hs": "haskell",
    ".ex": "elixir",
    ".ps1": "powershell",
    ".rst": "rst",
    ".go": "go",
}

# -- fixed values: text -----------------------------------------------------

# The characters Python's str.strip() removes.
PYTHON_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

PAGE_SEPARATOR = "\n\n"
CELL_SEPARATOR = " | "
HEADER_MARK = "=== Header ==="
TABLE_MARK = "=== Table ==="
SHEET_MARK = "=== Sheet: {sheet} ==="
MISSING_CELL = "N/A"

# The strings pandas.read_csv reads as a missing value.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# -- fixed values: chunking -------------------------------------------------

CHUNK_SIZE = 2000
CHUNK_OVERLAP = 200
DEFAULT_SEPARATORS = ["\n\n", "\n", " ", ""]
HTML_SECTION_TAGS = [
    "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "main", "nav",
]

# Words that open a top-level construct, per language, as public splitters of source
# code use them. A splitting separator is a newline, the word and a space.
LANGUAGE_KEYWORDS = {
    "python": "class def",
    "java": "class public protected private static if for while switch case",
    "kotlin": "class public protected private internal companion fun val var if for while when case else",
    "js": "function const let var class if for while switch case default",
    "ts": "enum interface namespace type class function const let var if for while switch case default",
    "php": "function class if foreach while do switch case",
    "proto": "message service enum option import syntax",
    "cpp": "class void int float double if for while switch case",
    "c": "class void int float double if for while switch case",
    "ruby": "def class if unless while for do begin rescue",
    "rust": "fn const let if while for loop match",
    "scala": "class object def val var if for while match case",
    "swift": "func class struct enum if for while do switch case",
    "sol": "pragma using contract interface library constructor type function event modifier error struct enum if for while assembly",
    "csharp": "interface enum implements delegate event class abstract public protected private static return if continue for foreach while switch case break try throw finally catch",
    "lua": "local function if for while repeat",
    "perl": "package sub if unless for foreach while",
    "haskell": "main let in do data newtype type module import qualified where case",
    "elixir": "def defp defmodule defprotocol defmacro defmacrop if unless while case cond with for do",
    "powershell": "function param if foreach for while switch class try catch finally",
    "go": "func var const type if for switch case",
    "cobol": "IDENTIFICATION ENVIRONMENT DATA PROCEDURE WORKING-STORAGE LINKAGE FILE INPUT-OUTPUT OPEN CLOSE READ WRITE IF ELSE MOVE PERFORM UNTIL VARYING ACCEPT DISPLAY STOP",
}

# Separators of a language besides those of its words.
LANGUAGE_SEPARATORS = {"python": ["\n\tdef "]}

# Markup languages split at patterns (regular expressions), not at words.
MARKUP_SEPARATORS = {
    "markdown": [r"\n#{1,6} ", r"```\n", r"\n\*\*\*+\n", r"\n---+\n", r"\n___+\n"],
    "rst": [r"\n=+\n", r"\n-+\n", r"\n\*+\n", r"\n\n\.\. *\n\n"],
    "latex": [
        r"\n\\chapter\{", r"\n\\section\{", r"\n\\subsection\{",
        r"\n\\subsubsection\{", r"\n\\begin\{",
    ],
    "html": [
        "<body", "<div", "<p", "<br", "<li", "<h1", "<h2", "<h3", "<h4", "<h5",
        "<h6", "<span", "<table", "<tr", "<td", "<th", "<ul", "<ol", "<header",
        "<footer", "<nav", "<head", "<style", "<script", "<meta", "<title",
    ],
}

# -- fixed values: prompts --------------------------------------------------

GENERATION_PROMPT = """\
Generate any number of questions and their answers based on the following text.
The number of questions generated can be based on the context itself.
Respond with a JSON array containing objects with 'instruction', 'input', and 'output' keys.
The 'instruction' should be the question, 'input' can be any sample inputs, and if there is no input,
it should be an empty string, and 'output' should be the answer.
Focus on general questions relevant to the given text.
There's no need to generate questions related to location, time, or other specific details of the documents.
Text: {text}"""

VERIFICATION_PROMPT = """\
You are a helpful assistant that verifies the relevance of a question and the correctness of an answer based on the provided context.

Context: {context}
Question: {question}
Answer: {answer}

Determine if the question is relevant to the context and if the answer is correct and relevant to the context.

Respond with either 'CORRECT' or 'INCORRECT', followed by a brief explanation.

Provide your response **exactly** in the following JSON format:

{{
    "verdict": "CORRECT" or "INCORRECT",
    "explanation": "Your brief explanation here."
}}

**Example response:**

{{
    "verdict": "CORRECT",
    "explanation": "The answer accurately reflects the information in the context."
}}"""

UNEXPECTED_VERDICT = "Unexpected verification response"

# -- fixed values: usage and limits -----------------------------------------

INPUT_PRICE_PER_MILLION = 0.150
OUTPUT_PRICE_PER_MILLION = 0.600
REQUESTS_PER_MINUTE = 29
TOKENS_PER_MINUTE = 14000
RATE_WINDOW_SECONDS = 60
