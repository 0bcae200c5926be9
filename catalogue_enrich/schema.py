"""Names and types of the article document and of the rows derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the article document.
PRODUCT_ID = "ProduktID"
COLOUR_ID = "FarbID"
SUPPLIER_ARTICLE = "LiefArtNrBer"
TARGET_GROUP = "Geschlecht"
IMAGE_KEYS = ("Hauptbild", "Freisteller Back", "Modellbild")
CATEGORIES = "Klassifikation"
ATTRIBUTES = "Klassifikations-Attribute"
IDENTIFIER = "Identifier"
CATEGORY_LABEL = "Bezeichnung"
LABEL = "Bezeichner"
KIND = "Typ"
DESCRIPTION = "Beschreibung"
ORIENTATION = "Orientierung"
OPTIONS = "Attributwerte"
RESULT = "Ausgewaehlter Attributwert (Result)"

# The two attribute ids with rules of their own.
COLOUR_ATTRIBUTE = "farbe"
HEX_ATTRIBUTE = "farbHex"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


OPTION_VALUE = T.StructType(_strings(IDENTIFIER, LABEL, DESCRIPTION))

ATTRIBUTE = T.StructType(
    _strings(IDENTIFIER, LABEL, KIND, RESULT, DESCRIPTION, ORIENTATION)
    + [T.StructField(OPTIONS, T.ArrayType(OPTION_VALUE))]
)

# What enrichment reads of an attribute.
READ_ATTRIBUTE = T.StructType(
    _strings(IDENTIFIER, LABEL, RESULT, ORIENTATION)
    + [T.StructField(OPTIONS, T.ArrayType(T.StructType(_strings(IDENTIFIER, LABEL))))]
)

# The document as a struct: for tables and for JSON whose fields are all known.
# It drops unknown keys, so documents that are written back use the text carrier.
ARTICLE = T.StructType(
    _strings(PRODUCT_ID, COLOUR_ID, SUPPLIER_ARTICLE, TARGET_GROUP, *IMAGE_KEYS)
    + [
        T.StructField(
            CATEGORIES, T.ArrayType(T.StructType(_strings(IDENTIFIER, CATEGORY_LABEL)))
        ),
        T.StructField(ATTRIBUTES, T.ArrayType(ATTRIBUTE)),
    ]
)

# Raw documents as the readers return them.
RAW = T.StructType(_strings("source_path", "source_file", "document"))

# One answer of a model for one attribute.
ANSWERS = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("answer", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("tries", T.IntegerType()),
        ]
    )
)

# Failed-image ledger.
LEDGER_KEY = ["product_id", "supplier_colour", "url"]

# The batch that a row belongs to, where several are run together; partitions of tables have its name.
BATCH = "batch_id"

# How the read error of a file that is not UTF-8 begins.
INVALID_UTF8 = "invalid UTF-8"
INVALID_JSON = "invalid_json"
