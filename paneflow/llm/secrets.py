"""Secret scans: fixed patterns, and strings that a primed compressor finds new.

Three kinds are matched by pattern: ``assign``, ``access`` and ``hex``. The fourth, ``novel``, is
measured: a candidate is a run of token characters that has a sensitive word closely before or
behind it, or in it; runs joined by dots are as close as the nearest of them. Every candidate is
measured, and where it holds sensitive words, also the pieces between them. Its
marginal compressed size, by zstandard with a dictionary of identifiers, is that of the
text around it with the candidate less that without, in bytes per byte. The dictionary holds common
identifiers and the words that the documents' own identifiers are most often made of, counted over all
documents (``corpus_words``: letters only, in ``LEAST_DOCS`` documents or more, ``WORDS`` at most, the most
frequent ones). Strings that are made of
known identifiers or recur nearby cost little; those at ``NOVEL`` or more are reported, unless a
pattern has their place already or they are part of one that is reported.

Offsets are code points, ends exclusive. Documents that hold none of the words or runs that the
patterns need are passed over by searches of their bytes.

Cases: a null text is empty and has no spans; repeated rows stay; of equal strings each place is
a span; invalid surrogates cannot occur in the tables' texts; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import chunks

#: The patterns of the base kinds, in their order, with the least length that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "novel")

#: What a text with an ``assign`` match holds, in lower case.
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
#: Words near which a string may be a secret, in lower case.
SENSITIVE = re.compile(r"passw|passphrase|secret|token|api_?key|credential|bearer|authorization|private_?key", re.ASCII | re.IGNORECASE)
SENSITIVE_WORDS = (*ASSIGN_WORDS, b"passphrase", b"credential", b"bearer", b"authorization", b"privatekey", b"private_key")
LEAST_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Candidates that are joined by dots, with what is between them.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: Characters between a sensitive word and its candidate, and of text around that is compressed with it.
REACH, AROUND = 48, 256
#: Marginal compressed bytes per byte from which a candidate is new.
NOVEL = 0.7
#: Identifiers that prime the compressor.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_key private_key public_key credential credentials "
    "authorization Authorization: Bearer bearer Basic username user_name user_id session_id client_id client_secret refresh_token "
    "access_token id_token csrf_token auth_token config configuration settings environment variable default example placeholder "
    "changeme your_password_here your_token_here xxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ localhost http:// https:// import return function const let var def class self this string null none "
    "true false get_ set_ load_ read_ write_ _path _file _name _value _type _list _map _count _size _length"
).encode()

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,novelty:float>>"


#: Kinds of bytes: of an identifier, its capitals, its small letters, and what may stand behind a name.
_BYTES = np.arange(256)
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
_IN_NAME = _UPPER | _LOWER | (_BYTES >= 48) & (_BYTES <= 57) | (_BYTES == 95)
_BEHIND_NAME = np.isin(_BYTES, np.frombuffer(b"(=:", np.uint8))
#: The words of an identifier: those that random strings hardly hold.
WORD = re.compile(r"[A-Z]?[a-z]{2,19}|[A-Z]{3,20}")
#: How many words of the corpus prime the compressor, each in so many documents.
WORDS, LEAST_DOCS = 2048, 20


class Novelty:
    """Marginal compressed size of a string beside the text around it."""

    def __init__(self, identifiers: bytes = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode()
        own = text[start:end].encode()
        without, whole = (len(self._compressor.compress(x)) for x in (around, around + own))
        return (whole - without) / len(own)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern kinds."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return found


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what may be a secret by its context, a run before its parts."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    for token in TOKEN.finditer(text) if words else ():
        near = bisect_left(ends, token.start() - REACH)
        if near == len(words) or starts[near] > token.end() + REACH:
            continue
        for run in CANDIDATE.finditer(text, token.start(), token.end()):
            start, end = run.span()
            inside = words[bisect_left(starts, start) : bisect_left(starts, end)]
            # the whole and the pieces that the words leave, which are as long as the whole together
            parts = [(start, end), *zip([start, *(e for _, e in inside)], [*(s for s, _ in inside), end], strict=True)]
            yield from ((s, e) for s, e in parts if e - s >= LEAST_CANDIDATE)


def spans_of(text: str, novelty: Novelty) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, novelty) by start and kind; novelty only for what was measured."""
    base = base_spans(text)
    found = [(start, kind, end, None) for start, kind, end in base]
    base_starts, base_ends = sorted(s for s, _, _ in base), list(accumulate((e for _, _, e in sorted(base)), max))
    last = (0, 0)
    for start, end in sorted(set(candidates(text)), key=lambda x: (x[0], -x[1])):
        before = bisect_left(base_starts, end)  # base spans that start before the candidate's end
        if last[0] <= start and end <= last[1] or (before and base_ends[before - 1] > start):
            continue
        if (new := novelty(text, start, end)) >= NOVEL:
            found.append((start, 3, end, new))
            last = (start, end)
    return [(KINDS[kind], start, end, new) for start, kind, end, new in sorted(set(found), key=lambda x: x[:3])]


_IN_HEX = np.zeros(256, bool)
_IN_HEX[48:58] = _IN_HEX[97:103] = True


def _may_hold(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a run of hexadecimal digits that is long enough, or one of the words."""
    run, n = _IN_HEX[flat], 1
    while n < LEAST_HEX and len(run) > n:
        run, n = run[:-n] & run[n:], 2 * n
    may = np.zeros(len(offsets) - 1, bool)
    if n >= LEAST_HEX:
        may[np.searchsorted(offsets, np.nonzero(run)[0], "right") - 1] = True
    raw = flat.tobytes()
    for needle, hay in [(b"AKIA", raw), *((w, low) for low in [raw.lower()] for w in SENSITIVE_WORDS)]:
        at = hay.find(needle)
        while at >= 0:
            d = int(np.searchsorted(offsets, at, "right")) - 1
            may[d] = True
            at = hay.find(needle, max(at + 1, int(offsets[d + 1]) - len(needle) + 1))
    return may


def identifiers(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the identifiers: names of several words, or before a bracket, equals sign or colon."""
    inside = _IN_NAME[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(stop) + 1
    joint = flat == 95
    joint[1:] |= _UPPER[flat[1:]] & _LOWER[flat[:-1]]
    ahead = np.concatenate([[0], np.cumsum(joint)])
    behind = np.zeros(len(flat) + 1, bool)
    behind[:-1] = _BEHIND_NAME[flat]
    mine = (ahead[end] > ahead[np.minimum(start + 1, end)]) | behind[end]
    start, end = start[mine], end[mine]
    return np.searchsorted(offsets, start, "right") - 1, start, end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, documents) of the words of identifiers, an Arrow batch at a time."""
    for batch in batches:
        found: Counter[str] = Counter()
        for _, _, flat, offsets in chunks(batch.column(0)):
            raw, names = flat.tobytes(), {}
            for doc, start, end in zip(*(x.tolist() for x in identifiers(flat, offsets)), strict=True):
                names.setdefault(raw[start:end], set()).add(doc)
            held: dict[str, set[int]] = {}
            for name, docs in names.items():
                for word in WORD.findall(name.decode("ascii")):
                    held.setdefault(word, set()).update(docs)
            found.update({word: len(docs) for word, docs in held.items()})
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])


def corpus_words(docs: DataFrame, text: str = "text", most: int = WORDS, least_docs: int = LEAST_DOCS) -> list[str]:
    """The words that identifiers of the documents are most often made of, the rarest first; ``most`` bounds
    what comes to the driver."""
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_count_words, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_docs)
    return [r.word for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()][::-1]


def _scan(batches: Iterator[pa.RecordBatch], identifiers: bytes) -> Iterator[pa.RecordBatch]:
    novelty = Novelty(identifiers)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float32())]))
    for batch in batches:
        out = []
        for first, last, flat, offsets in chunks(batch.column(1)):
            may = _may_hold(flat, offsets)
            for d in range(last - first):
                spans = spans_of(flat[offsets[d] : offsets[d + 1]].tobytes().decode(), novelty) if may[d] else []
                out.append([dict(zip(("kind", "start", "end", "novelty"), s, strict=True)) for s in spans])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): all spans of each document, by start and kind."""
    # The compressor finds what is nearest to the dictionary's end with the least bytes: the typed ones go last.
    identifiers = " ".join(corpus_words(docs, text)).encode() + b" " + IDENTIFIERS
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda batches: _scan(batches, identifiers), f"doc_id long, spans {SPAN_TYPE}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans, one row per document."""
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    names = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(names, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
