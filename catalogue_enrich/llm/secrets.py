"""Secret scans: fixed patterns, and novelty of strings in sensitive context.

The fixed patterns find assignments, access keys and long hexadecimal strings. Beyond them, a
string that follows a sensitive word is a candidate; its novelty is the number of bytes by which
it lengthens the compressed form of its surroundings, where the compressor is primed with a
dictionary of code and identifiers. A name or a phrase costs a few bytes, a random string most of
its own length: a candidate is reported if the added bytes are at least ``min_ratio`` of its own
(0.6: random small letters cost 0.59 of a byte each).
What the fixed patterns find is measured in the same way and stays whatever it measures.

A string is in sensitive context if a sign (colon, equals, quote, bracket) or a word such as "is"
stands between it and the sensitive word, which may have any ending (``auth_token2``,
``private_key_production_value``). Then its bytes alone decide. After mere white space, as in a
sentence, a string is a candidate only if it has two of small letters, capitals and digits.

The dictionary is a fixed text and the identifiers of the corpus: the words of 6 to 64 characters
that occur in at least ``SEEN_IN`` different texts, the ``KNOWN`` most frequent. All texts are
counted, each different one once. Only what is outside of sensitive context is counted, so a value
that has leaked into many documents does not become known by that.

Defined results: a null or empty text has no spans, and an empty table no rows; a text of any
length is scanned whole; equal rows have equal results; positions are code points, end exclusive.
Other columns of the input are kept; the result is one struct column, under a name not yet taken.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

# The kinds in the order in which spans of one start are listed.
ASSIGN, ACCESS, HEX, NOVEL = "assign", "access", "hex", "novel"
KINDS = (ASSIGN, ACCESS, HEX, NOVEL)
ASSIGNMENT = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A key's length is tested here: its run is the same with and without the test.
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
ASSIGNED_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# A sensitive word with its ending, at most 24 characters of quotes, signs and spaces, then a
# string of at least 10 characters.
SENSITIVE = re.compile(
    r"(?ai:passphrase|password|passwd|pwd|secret|token|api[_-]?key|private[_-]?key|access[_-]?key"
    r"|credential|authorization|bearer|client[_-]?id|signature|auth)"
    r"[A-Za-z0-9_-]{0,64}(?P<between>[\s\"'`:=>(\[-]{1,24}(?:(?ai:is|was|bearer|basic)[\s\"':=]{1,4})?)"
    r"(?P<value>[A-Za-z0-9+/_.=~$!@%^&*-]{10,})"
)
SENSITIVE_WORDS = (
    "passphrase password passwd pwd secret token apikey api_key api-key private access "
    "credential authorization bearer client signature auth"
).split()

# An identifier or word, which begins with a letter.
WORD = re.compile(r"[A-Za-z][A-Za-z0-9_.-]{5,63}")
# Different texts that must have a word, and words of the corpus in the dictionary.
SEEN_IN, KNOWN = 3, 4096

# What the compressor has seen before: code, configuration and identifiers without any value.
IDENTIFIERS = (
    "import os sys json from return def class public static final void String int self this new "
    "function const let var null None True False true false async await try except catch finally "
    "os.environ.get getenv process.env config settings application.properties localhost "
    "https://www.example.com/index.html http://localhost:8080/api/v1/users "
    "username user_name password passwd secret secret_key token access_token refresh_token "
    "api_key apiKey client_id client_secret authorization Authorization: Bearer Basic "
    "your_password_here your-api-key-here changeme example placeholder xxxxxxxxxxxxxxxx "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ ${PASSWORD} {{ token }} "
    "get_password set_password reset_password password_hash validate_token create_token "
    "tokenizer tokenization tokenize token_count max_tokens num_tokens secretary authentication "
    "authenticate author authority authorized_keys private_key public_key access_key signature "
    "the of and to in that is was for with this from are by be not on at as have has which "
)

RESULT = pa.struct(
    [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64())]
    + [("n_novel", pa.int64())]
    + [("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64())]
       + [("stop", pa.int64()), ("novelty", pa.float64())])))]
)
RESULT_DDL = (
    "n_assign long, n_access long, n_hex long, n_novel long, "
    "found array<struct<kind string, start long, stop long, novelty double>>"
)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """Start, kind and end of what the fixed patterns find."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGNED_WORDS):
        spans += [
            (m.start(), ASSIGN, m.end())
            for m in ASSIGNMENT.finditer(text)
            if len(m.group(2)) >= 6
        ]
    if "AKIA" in text:
        spans += [(m.start(), ACCESS, m.end()) for m in ACCESS_KEY.finditer(text)]
    return spans + [(m.start(), HEX, m.end()) for m in HEX_RUN.finditer(text)]


class Novelty:
    """Bytes that a string adds to the compressed form of what surrounds it."""

    def __init__(self, context: int, words: list[str] | None = None, level: int = 19):
        text = " ".join([*(words or []), IDENTIFIERS])
        primed = zstandard.ZstdCompressionDict(
            text.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        primed.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(
            level=level, dict_data=primed, write_content_size=False, write_dict_id=False
        )
        self.context = context

    def added(self, text: str, start: int, stop: int) -> float:
        """Added bytes as a share of the string's own."""
        before = text[max(0, start - self.context) : start].encode("utf-8", "replace")
        after = text[stop : stop + self.context].encode("utf-8", "replace")
        own = text[start:stop].encode("utf-8", "replace")
        without = len(self.compressor.compress(before + after))
        # The string comes last: its cost is then that of telling it, given the rest.
        return (len(self.compressor.compress(before + after + own)) - without) / len(own)


def candidates(text: str) -> list[tuple[int, int]]:
    """Strings in sensitive context."""
    lowered = text.lower()
    if not any(word in lowered for word in SENSITIVE_WORDS):
        return []
    out = []
    for m in SENSITIVE.finditer(text):
        own = m["value"]
        kinds = sum(bool(re.search(k, own)) for k in ("[a-z]", "[A-Z]", "[0-9]"))
        if kinds >= 2 or not m["between"].isspace():
            out.append(m.span("value"))
    return out


def novel_spans(
    text: str, taken: list[tuple[int, str, int]], novelty: Novelty, min_ratio: float
) -> list[tuple[int, str, int, float]]:
    """Candidates outside the spans ``taken`` whose novelty is at least ``min_ratio``."""
    spans = []
    for start, stop in candidates(text):
        if any(a < stop and start < b for a, _, b in taken):
            continue
        if (ratio := novelty.added(text, start, stop)) >= min_ratio:
            spans.append((start, NOVEL, stop, ratio))
    return spans


def plain_words(text: str) -> set[str]:
    """Words outside of sensitive context and of what the fixed patterns find."""
    hidden = [(start, stop) for start, _, stop in base_spans(text)] + candidates(text)
    pieces, at = [], 0
    for start, stop in sorted(hidden):
        pieces.append(text[at : max(at, start)])
        at = max(at, stop)
    pieces.append(text[at:])
    return {word for piece in pieces for word in WORD.findall(piece)}


def known_words(documents: DataFrame, text: str, known: int = KNOWN) -> list[str]:
    """Identifiers of the corpus, at most ``known``, the most frequent last, where the compressor
    finds them best."""

    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        rows = [sorted(plain_words(t.as_py())) for t in texts]
        return pa.array(rows, pa.list_(pa.string()))

    texts = documents.select(F.col(text).cast("string").alias("text")).where("text is not null")
    # Copies count once: texts are shuffled by their hash, and the words of each are counted where it is.
    texts = texts.groupBy(F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text"))
    found = texts.select(F.explode(words("text")).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= SEEN_IN)
    # At most ``known`` words of at most 64 characters; an aggregate, so that those of each task meet
    # in a task and not in the driver.
    most = counts.orderBy(F.desc("n"), "word").limit(known)
    rows = most.agg(F.collect_list(F.struct("n", "word")).alias("rows")).first()["rows"]
    return [r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))][::-1]


def scan_secrets(
    documents: DataFrame,
    text: str = "text",
    context: int = 256,
    min_ratio: float = 0.6,
    known: int = KNOWN,
    result: str = "secrets",
) -> tuple[DataFrame, str]:
    """``documents`` with a struct of counts and spans, and the name of that column."""

    def scan(value: str, novelty: Novelty) -> dict:
        base = base_spans(value)
        spans = [(*span, novelty.added(value, span[0], span[2])) for span in base]
        spans += novel_spans(value, base, novelty, min_ratio)
        spans.sort(key=lambda s: (s[0], KINDS.index(s[1])))
        counts = {kind: sum(s[1] == kind for s in spans) for kind in KINDS}
        return {f"n_{kind}": n for kind, n in counts.items()} | {
            "found": [
                {"kind": kind, "start": start, "stop": stop, "novelty": ratio}
                for start, kind, stop, ratio in spans
            ]
        }

    words = known_words(documents, text, known)
    made: list[Novelty] = []

    @F.arrow_udf(RESULT_DDL)
    def scanned(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Novelty(context, words))
        novelty = made[0]
        return pa.array([scan(t.as_py() or "", novelty) for t in texts], RESULT)

    name = free_name(documents, result)
    return documents.withColumn(name, scanned(F.col(text).cast("string"))), name


def spans_text(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, kind, stop in spans)


def base_digest(text: str) -> str:
    """Digest of the base spans of one text; what queries derive in SQL."""
    spans = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[1])))
    return hashlib.sha256(spans_text(spans).encode()).hexdigest()
