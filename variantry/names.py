"""Column names that more than one module agrees on."""

# Key columns and the default cohort columns.
COLLAPSE_KEYS = ["SAMPLE", "CHROM", "POS", "REF", "ALT", "FORMAT['SAOBS']"]
SITE_KEYS = ["CHROM", "POS", "REF", "ALT"]
UNIQUE_KEYS = ["SAMPLE", "CHROM", "POS", "REF", "ALT"]
COHORT_ANNOTATIONS = [
    "ANN['MAX_AF']",
    "ANN['VARIANT_CLASS']",
    "ANN['Feature_type']",
    "ANN['IMPACT']",
    "ANN['SYMBOL']",
]
SYMBOL = "ANN['SYMBOL']"
SAMPLE_AF = "FORMAT['AF']"

# Texts that stand for "no value".
MISSING_MARKS = ("", ".", "NA", "NULL", "null")

# Position of a row in its source table. It carries the meaning of "first
# appearance" through shuffles and is never part of a result.
ROW_ORDER = "_row_order"

# Position of a row's dataset in the list of datasets of a cohort.
DATASET_INDEX = "_dataset_index"

# Name of the dataset a collapsed row came from. Exports call it FILENAME; inside
# Spark that would clash with `filename`, since names are case-insensitive.
SOURCE_DATASET = "SOURCE_DATASET"
SOURCE_DATASET_EXPORTED = "FILENAME"

ROW_COUNT = "ROW_COUNT"
