"""Secret scans: key patterns, and the token efficiency of long strings (operator 13).

Three patterns find assigned credentials, access keys and hexadecimal runs.  Besides, a
text's long unbroken strings are encoded with a public vocabulary.  Written language,
code and names need few tokens for their characters; a random string needs many, as
no merge of the vocabulary was made for it.  A string of few characters a token counts
as a secret, unless it is a known digest (by length, of one case; subresource hashes;
UUIDs), a date or an ordinary number with separators, a plain word, or an identifier
whose words, split at separators, humps and digits, are long on average.  Strings that
meet a pattern's span are left to it.

Spans are half-open, in code points.  A vocabulary has a fixed size, checked on the
driver, and goes to the workers once, which build the encoder at their first string.
Texts are searched whole; a longer string is encoded in runs of ``RUN`` characters, all
of them, so that its cost follows its length.  No row depends on another: no shuffle.

Cases: null and empty texts have no spans; a null doc_id and repeated rows stay rows of
their own; spans of one start are ordered by kind; an empty table gives no rows; other
columns, whatever their names, come out unchanged and ``spans`` replaces one of its name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 64 << 20
KINDS = ("assign", "access", "hex", "random")
LEAST = 16  # characters of a string that is encoded
RATIO = 2.0  # characters a token, from which a string is not random
PIECE = 4.0  # mean length of an identifier's words
RUN = 1024
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))

# How the vocabulary's texts were split before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_STRING = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
# What a text must hold to be looked at: one pass over whole columns.
_ANY = rf"(?i:password|passwd|secret|token|api_?key)|AKIA|[A-Za-z0-9+/_=-]{{{LEAST},}}"

_HEXADECIMAL = re.compile(r"(0[xX])?([0-9a-f]+|[0-9A-F]+)")
_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
_KNOWN = re.compile(
    r"sha(1|256|384|512)-[A-Za-z0-9+/]+=*"  # subresource hashes
    r"|[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"  # UUIDs
    r"|\d{4}-\d\d-\d\dT\d\d[0-9-]*Z?"  # times
    r"|[A-Za-z]{0,5}[-_/=+]*\d+([-_/=+]+\d+)*[-_/=+]*[A-Za-z]?"  # numbers, also ISBN and the like
)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three patterns, leftmost and apart within a kind.

    A run that is too short for its kind holds no longer one, but an assignment with
    a short value can, so that one is found first and dropped then.
    """
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def is_known(string: str) -> bool:
    """Whether a string is a digest, a number, a word or an identifier by its form."""
    digest = _HEXADECIMAL.fullmatch(string)
    if digest and len(digest.group(2)) in _DIGEST_LENGTHS:
        return True
    if string.isalpha() and (string.islower() or string.isupper() or string.istitle()):
        return True
    if _KNOWN.fullmatch(string):
        return True
    pieces = _PIECE.findall(string)
    return not pieces or sum(map(len, pieces)) >= PIECE * len(pieces)


def efficiency(string: str, encoder: tiktoken.Encoding) -> float:
    """Characters a token of the whole string."""
    tokens = sum(len(encoder.encode_ordinary(string[i : i + RUN])) for i in range(0, len(string), RUN))
    return len(string) / max(tokens, 1)


def random_spans(text: str, taken: list[tuple[str, int, int]], encoder, ratio: float) -> list[tuple[str, int, int]]:
    """Spans of strings below ``ratio`` characters a token, apart from ``taken`` spans."""
    found, marks, k = [], sorted((a, b) for _, a, b in taken), 0
    reach = -1  # end of the taken spans that start before the string's end
    for m in _STRING.finditer(text):
        string = m.group().strip("-_/+=")
        start = m.start() + len(m.group()) - len(m.group().lstrip("-_/+="))
        end = start + len(string)
        while k < len(marks) and marks[k][0] < end:
            reach = max(reach, marks[k][1])
            k += 1
        if len(string) < LEAST or reach > start or is_known(string):
            continue
        if efficiency(string, encoder()) < ratio:
            found.append(("random", start, end))
    return found


_encoders: dict[int, tiktoken.Encoding] = {}


def _encoder(ranks: bytes) -> tiktoken.Encoding:
    """The vocabulary's encoder, built once in a worker."""
    key = hash(ranks)
    if key not in _encoders:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        _encoders[key] = tiktoken.Encoding("given", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})
    return _encoders[key]


def find_secrets(documents: DataFrame, vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """All rows of ``documents`` without their text, and ``spans``: (kind, start, end) of
    each secret, by start, then kind.  ``vocabulary`` is a rank file on the driver."""
    path = Path(vocabulary)
    if path.stat().st_size > VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} has more than {VOCABULARY_BYTES} bytes")
    ranks = documents.sparkSession.sparkContext.broadcast(path.read_bytes())
    kept = [c for c in documents.columns if c not in ("text", "spans")]
    order = {kind: i for i, kind in enumerate(KINDS)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            hits = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_pylist()
            rows = []
            for i, hit in enumerate(hits):
                found = []
                if hit:
                    text = texts[i].as_py()
                    found = base_spans(text)
                    found += random_spans(text, found, lambda: _encoder(ranks.value), ratio)
                    found.sort(key=lambda s: (s[1], order[s[0]]))
                rows.append([{"kind": kind, "start": a, "end": b} for kind, a, b in found])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            columns = [*batch.columns[: len(kept)], pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "spans"])

    schema = documents.select(*kept).schema.add("spans", SPANS)
    return documents.select(*kept, F.col("text").cast("string")).mapInArrow(scan, schema)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
