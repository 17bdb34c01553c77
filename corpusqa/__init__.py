"""Question/answer training rows from document collections, on Spark."""

import sys

from pyspark import cloudpickle

from corpusqa.functions.tokens import bpe_counter, counter_from, estimate_tokens
from corpusqa.operators.usage import average_cost, usage_by_op, usage_summary
from corpusqa.plans.mining import Mined, mine, mine_documents, process_text, verify_dataset
from corpusqa.sources.files import extract_text, list_files, read_texts

# The few Python functions that run in tasks travel with the plan, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

__all__ = [
    "Mined",
    "average_cost",
    "bpe_counter",
    "counter_from",
    "estimate_tokens",
    "extract_text",
    "list_files",
    "mine",
    "mine_documents",
    "process_text",
    "read_texts",
    "usage_by_op",
    "usage_summary",
    "verify_dataset",
]
