"""Periodic runs: stretches of words that repeat one block four times and more, and texts without the repeats.

Periods are dealt with by octave: those in ``[S, 2 S)`` share one cut of the document into overlapping tiles,
``2 S`` words left of a boundary and ``6 S`` words right of it, a boundary every ``2 S`` words. A run of such
a period is at least four periods long, so it holds a boundary with two whole periods after it, and two
tiles next to each other share more than a period of it. A tile is solved by itself: the Z-function of the
words after the boundary gives every square that starts there and tells which of them are no powers of a
shorter block, and the words before the boundary extend it to the left. Tiles at whose boundary no period
matches for eight words are passed over. A tile gives intervals with their period; fragments meet by
document and period, where those that share at least a period's words are one run.

The work is in proportion to the words of a document and the logarithm of their number; what is shuffled is
intervals. A document is read and cut into tiles where its row is read, in one task; its tiles need the
words of the text and no more. Words are compared as they are, not by hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.frames import map_batches, table

MIN_WORDS = 6
MIN_PERIODS = 4
#: Words that have to match at a boundary before its Z-function is computed.
FIRST_WORDS = 8
#: Words of a block of documents, and cells of a matrix of boundaries and periods.
BLOCK_WORDS = 1 << 20
CELLS = 1 << 20

FRAGMENTS = "key binary, period long, start long, end long"
RUN = "struct<start:bigint,period:bigint,length:bigint>"


def z_function(x: list[int]) -> list[int]:
    """For every place the length of the longest common start of ``x`` and its rest from there."""
    n = len(x)
    z = [n] + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def boundaries(begin: np.ndarray, end: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The boundaries of an octave in documents ``[begin, end)``, with the index of their document."""
    size = end - begin
    long_enough = np.flatnonzero(size >= max(MIN_WORDS, MIN_PERIODS * scale))
    counts = (size[long_enough] - 2 * scale) // (2 * scale) + 1
    doc = np.repeat(long_enough, counts)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return begin[doc] + 2 * scale * place, doc


def promising(t: np.ndarray, at: np.ndarray, end: np.ndarray, scale: int) -> np.ndarray:
    """Indexes of the boundaries at which some period of the octave matches for its first words."""
    found = []
    rows = max(1, CELLS // scale)
    periods = np.arange(scale, 2 * scale)
    for first in range(0, len(at), rows):
        c, stop = at[first : first + rows], end[first : first + rows]
        fits = c[:, None] + 2 * periods <= stop[:, None]
        tile, q = np.nonzero(fits & (t[c[:, None] + periods] == t[c][:, None]))
        q = q + scale
        for j in range(1, min(scale, FIRST_WORDS)):
            same = t[c[tile] + j] == t[c[tile] + q + j]
            tile, q = tile[same], q[same]
        found.append(np.unique(tile) + first)
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def solve(t: np.ndarray, c: int, begin: int, end: int, scale: int) -> Iterator[tuple[int, int, int]]:
    """The stretches (period, start, end) of one tile: those whose block is no power of a shorter one,
    and that are long enough for a run or cut off by the tile."""
    stop = min(c + 6 * scale, end)
    x = t[c:stop].tolist()
    z = z_function(x)
    least = 1
    for q in range(scale, min(2 * scale, len(x) // 2 + 1)):
        if z[q] < q:
            continue
        while least + z[least] < 2 * q:
            least += 1
        if least < q:
            continue
        right = c + q + z[q]
        low = max(c - 2 * scale, begin)
        other = np.flatnonzero(t[low:c] != t[low + q : c + q])
        left = low + int(other[-1]) + 1 if len(other) else low
        open_ends = (left == low > begin) or (right == stop < end)
        if open_ends or right - left >= max(MIN_WORDS, MIN_PERIODS * q):
            yield q, left, right


def fragments(t: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (document, period, start, end) for documents ``t[offsets[i]:offsets[i + 1]]``; places count
    from the start of the document. Neighbours that are one run are put together."""
    begin, end = offsets[:-1], offsets[1:]
    found = []
    scale, longest = 1, int((end - begin).max(initial=0))
    while max(MIN_WORDS, MIN_PERIODS * scale) <= longest:
        at, doc = boundaries(begin, end, scale)
        for i in promising(t, at, end[doc], scale):
            d = doc[i]
            for q, left, right in solve(t, int(at[i]), int(begin[d]), int(end[d]), scale):
                found.append((d, q, left - begin[d], right - begin[d]))
        scale *= 2
    rows = np.array(found, dtype=np.int64).reshape(-1, 4)
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1) | (rows[1:, 2] > rows[:-1, 3] - rows[1:, 1])
    first = np.flatnonzero(fresh)
    merged = rows[first]
    merged[:, 3] = np.maximum.reduceat(rows[:, 3], first)
    return merged


def _words(column: pa.Array) -> list[list[bytes]]:
    return [(text or b"").split() for text in pc.cast(column, pa.large_binary()).to_pylist()]


def _fragments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    keys, texts = batch.column("key"), batch.column("text")
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        # A word and its separator are two bytes at least.
        to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 2 * BLOCK_WORDS, side="right"))
        to = max(to, at + 1)
        known: dict[bytes, int] = {}
        codes, offsets = [], [0]
        for words in _words(texts.slice(at, to - at)):
            codes += [known.setdefault(w, len(known)) for w in words]
            offsets.append(len(codes))
        rows = fragments(np.array(codes, dtype=np.int64), np.array(offsets))
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [keys.slice(at, to - at).take(pa.array(rows[:, 0])), *[pa.array(rows[:, k]) for k in (1, 2, 3)]],
                names=["key", "period", "start", "end"],
            )
        at = to


def stitched(found: DataFrame) -> DataFrame:
    """Whole runs (key, period, start, length) from the fragments of all tiles."""
    ordered = Window.partitionBy("key", "period").orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    joins = F.coalesce(F.col("start") <= reached - F.col("period"), F.lit(False))
    islands = found.withColumn("joins", joins).withColumn("run", F.sum((~F.col("joins")).cast("long")).over(ordered))
    whole = islands.groupBy("key", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.filter(length >= F.greatest(F.lit(MIN_WORDS), MIN_PERIODS * F.col("period"))).select(
        "key", "period", "start", length.alias("length")
    )


def _key(doc_id: str, text: str) -> Column:
    """A digest of id and text: rows that agree in both have the same runs."""
    named = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(named, F.lit(" "), F.coalesce(F.col(text), F.lit("")))))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All runs of all documents: one row (key, period, start, length) each; ``key`` is the digest of id and text.

    A run is a stretch of words of smallest period ``period``, at least four periods and six words long,
    that no neighbouring word extends. Words are what ASCII white space parts; null text has none.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return stitched(map_batches(named.select(_key("doc_id", "text").alias("key"), "text"), FRAGMENTS, _fragments))


def _summary(words: list[bytes], found: list[dict]) -> tuple:
    """The columns of ``collapse`` for one document; ``found`` is ordered by start, then period."""
    listed = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in found)
    best = min(found, key=lambda r: (-r["length"], r["start"], r["period"]), default=None)
    if found:
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        for r in found:
            dropped[r["start"] + r["period"]] += 1
            dropped[r["start"] + r["length"]] -= 1
        kept = np.cumsum(dropped)[:-1] == 0
        words = [w for w, k in zip(words, kept) if k]
    return (
        len(found), *((best["start"], best["length"], best["period"]) if best else (None, None, None)),
        1000 * best["length"] // best["period"] if best else None, listed, b" ".join(words).decode(),
    )


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the longest run (start, length, period, exponent_milli), all runs
    as text (``start,length,period`` and a line feed each, by start, then period) and the collapsed text:
    the words that are in no run, or among the first period of every run they are in, joined by one space.

    With ``digests`` the last two are SHA-256 sums. Without words or text there are no runs and the
    collapsed text is empty. Repeated rows give repeated rows; an empty table gives an empty result.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    per_document = runs(named).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    keyed = named.withColumn("key", _key("doc_id", "text"))
    joined = keyed.join(per_document, "key", "left").select("doc_id", "text", "runs")

    def shown(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest() if digests else text

    def summarise(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for words, found in zip(_words(batch.column("text")), batch.column("runs").to_pylist()):
            *numbers, listed, text = _summary(words, found or [])
            rows.append((*numbers, shown(listed), shown(text)))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    kind = dict(named.dtypes)["doc_id"]
    numbers = ", ".join(f"{c} long" for c in names[1:6])
    return map_batches(joined, f"doc_id {kind}, {numbers}, runs string, collapsed string", summarise)


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where one document in ten, by the CRC of its id, is made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    listed = docs.select(
        "doc_id", "text", F.floor(h / 10).cast("long").alias("g"),
        F.when((h % 10 == 0) & (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) > 0),
               F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"),
    )
    n = F.size("words")
    placed = listed.withColumn("a", (F.col("g") % n).cast("int")).withColumn(
        "p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    )
    rest = n - F.col("a")
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    copies = F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int")))
    made = F.concat(F.slice("words", 1, F.col("a")), F.slice(copies, 1, rest))
    return placed.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op11_periods(spark, sf_dir) -> DataFrame:
    """All documents with their planted periods; runs and collapsed texts as digests."""
    found = collapse(planted(table(spark, sf_dir, "documents")), digests=True)
    return found.withColumnsRenamed({"runs": "runs_sha256", "collapsed": "collapsed_sha256"})
