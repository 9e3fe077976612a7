"""Benchmark decontamination by suffix arrays over the training documents.

Every block of documents (some megabytes) is a shard with a suffix array of its own. Words are
numbered by the benchmark's vocabulary; other words are 0 and end any match, so the array keeps only
suffixes whose run of known words is as long as the shortest window. Suffixes are ordered by their
first ``window`` words, packed in 64-bit keys. Every test suffix is a binary search for the range that
shares its first ``window`` words; from there a match is followed to its end, which gives the longest
verbatim matches with their locations. Items with fewer words than the window are looked up whole.

The benchmark is the stated query set. It is sent to the tasks in parts of at most ``part_words``
words, so what a task holds is bounded; a benchmark of more parts is searched for part by part, in
the same pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadlens.llm import kernels
from roadlens.llm.frames import map_batches, masked, table, unmasked

WINDOW = 10
PART_WORDS = 2_000_000


@dataclass
class Part:
    """Some benchmark items: sorted word hashes, and their words as numbers from 1, item after item."""

    items: list[str]
    vocabulary: np.ndarray
    words: np.ndarray
    bounds: np.ndarray


def parts(benchmark: DataFrame, id_col: str, text_col: str, part_words: int) -> list[Part]:
    """The benchmark in parts. Null ids are written ``null``; items without words are left out."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text")
    ).toArrow()
    ids = rows.column("id").to_pylist()
    found, items, words, size = [], [], [], 0

    def close() -> None:
        nonlocal items, words, size
        if items:
            known, numbers = np.unique(np.concatenate(words), return_inverse=True)
            bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
            found.append(Part(items, known, numbers.astype(np.int64) + 1, bounds))
        items, words, size = [], [], 0

    for block in kernels.blocks(rows.column("text")):
        w = kernels.words(block, kernels.ALNUM)
        edges = kernels.row_bounds(w.row, block.rows)
        for i in range(block.rows):
            if edges[i + 1] > edges[i]:
                items.append(ids[block.first + i])
                words.append(w.hash[edges[i] : edges[i + 1]])
                size += len(words[-1])
                if size >= part_words:
                    close()
    close()
    return found


def _keys(text: np.ndarray, at: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The ``n`` words from each position, packed in as few 64-bit keys as they need."""
    each = max(1, 64 // bits)
    keys = []
    for first in range(0, n, each):
        key = np.zeros(len(at), dtype=np.uint64)
        for i in range(first, min(first + each, n)):
            key = (key << np.uint64(bits)) | text[at + i].astype(np.uint64)
        keys.append(key)
    return keys


class SuffixArray:
    """Suffixes of a numbered text that begin with ``n`` known words, ordered by those words."""

    def __init__(self, text: np.ndarray, run: np.ndarray, n: int, bits: int):
        at = np.flatnonzero(run >= n)
        keys = _keys(text, at, n, bits)
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        self.at = at[order]
        self.keys = [k[order] for k in keys]

    def ranges(self, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For every searched window the range of suffixes that begin with it (binary search)."""
        low = np.searchsorted(self.keys[0], keys[0], "left")
        high = np.searchsorted(self.keys[0], keys[0], "right")
        for own, asked in zip(self.keys[1:], keys[1:], strict=True):
            for i in np.flatnonzero(high > low):
                inside = own[low[i] : high[i]]
                first = low[i]
                low[i] = first + np.searchsorted(inside, asked[i], "left")
                high[i] = first + np.searchsorted(inside, asked[i], "right")
        return low, high


def _runs(text: np.ndarray) -> np.ndarray:
    """How many known words follow each other from each position."""
    stop = np.flatnonzero(text == 0)
    places = np.arange(len(text))
    after = np.searchsorted(stop, places)
    return np.append(stop, len(text))[after] - places


def search(text: np.ndarray, part: Part, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All verbatim windows: position in the text, item, position in the item (sorted by them)."""
    bits = int(len(part.vocabulary)).bit_length()
    run = _runs(text)
    length = np.diff(part.bounds)
    positions, items, offsets = [], [], []
    for n in np.unique(np.minimum(length, window)):
        if n == window:
            own = np.flatnonzero(length >= window)
            count = length[own] - window + 1
            item = np.repeat(own, count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        else:
            item = np.flatnonzero(length == n)
            offset = np.zeros(len(item), dtype=np.int64)
        array = SuffixArray(text, run, int(n), bits)
        if not len(array.at):
            continue
        low, high = array.ranges(_keys(part.words, part.bounds[item] + offset, int(n), bits))
        hits = high - low
        if not hits.sum():
            continue
        place = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)
        positions.append(array.at[place])
        items.append(np.repeat(item, hits))
        offsets.append(np.repeat(offset, hits))
    if not positions:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    position, item, offset = (np.concatenate(x) for x in (positions, items, offsets))
    order = np.lexsort((position, position - offset, item))
    return position[order], item[order], offset[order]


def longest(position: np.ndarray, item: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and number of consecutive windows of each maximal match."""
    if not len(position):
        none = np.empty(0, dtype=np.int64)
        return none, none
    new = np.ones(len(position), dtype=bool)
    new[1:] = ~(
        (item[1:] == item[:-1])
        & (position[1:] - offset[1:] == position[:-1] - offset[:-1])
        & (position[1:] == position[:-1] + 1)
    )
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(position)))


MATCHES = "array<struct<item_id:string,item_word:long,doc_word:long,n_words:long>>"


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", part_words: int = PART_WORDS, carry: list[str] | None = None,
    locations: bool = True,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, items (distinct ids, sorted as strings) and the
    longest verbatim ``matches`` of ``window`` words or more (null unless ``locations``).

    ``carry`` names columns to take along instead of the id, as ``docs`` has them. Null and empty
    texts have no words; repeated rows are judged one by one; an empty benchmark matches nothing.
    """
    asked = parts(benchmark, item_id, item_text, part_words)
    broadcast = docs.sparkSession.sparkContext.broadcast(asked)
    kept = [f"`{c}`" for c in carry] if carry is not None else [f"`{id_col}` as doc_id"]
    source = docs.selectExpr(*kept, f"cast(`{text_col}` as string) as __searched")
    schema = StructType(
        source.drop("__searched").schema.fields
        + StructType.fromDDL(f"n_words long, n_hit long, items array<string>, matches {MATCHES}").fields
    )
    out = pa.list_(
        pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])
    )

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = batch.schema.names.index("__searched")
        rows = batch.num_rows
        n_words, n_hit = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
        ids: list[set[str]] = [set() for _ in range(rows)]
        spans: list[list] = [[] for _ in range(rows)]
        for block in kernels.blocks(batch.column(at)):
            w = kernels.words(block, kernels.ALNUM)
            edges = kernels.row_bounds(w.row, block.rows)
            here = slice(block.first, block.first + block.rows)
            n_words[here] = np.diff(edges)
            # one 0 after every text, so that no match goes over its end
            place = np.arange(len(w.hash)) + w.row
            marks = np.zeros(len(w.hash) + block.rows + 1, dtype=np.int64)
            for part in broadcast.value:
                found = np.searchsorted(part.vocabulary, w.hash)
                found[found == len(part.vocabulary)] = 0
                text = np.zeros(len(w.hash) + block.rows, dtype=np.int64)
                text[place] = np.where(part.vocabulary[found] == w.hash, found + 1, 0)
                position, item, offset = search(text, part, window)
                first, count = longest(position, item, offset)
                begin, which = position[first], item[first]
                size = count - 1 + np.minimum(np.diff(part.bounds)[which], window)
                np.add.at(marks, begin, 1)
                np.add.at(marks, begin + size, -1)
                row = np.searchsorted(edges[1:] + np.arange(block.rows), begin, side="right")
                for r, i in set(zip(row.tolist(), which.tolist(), strict=True)):
                    ids[block.first + r].add(part.items[i])
                if locations:
                    starts = begin - (edges[row] + row)
                    for r, i, o, s, n in zip(
                        row.tolist(), which.tolist(), offset[first].tolist(), starts.tolist(), size.tolist(), strict=True
                    ):
                        spans[block.first + r].append(
                            {"item_id": part.items[i], "item_word": o, "doc_word": s, "n_words": n}
                        )
            hit = np.concatenate([[0], np.cumsum(np.cumsum(marks)[:-1] > 0)])
            ends = edges + np.arange(block.rows + 1)
            n_hit[here] = np.diff(hit[np.minimum(ends, len(hit) - 1)])
        columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [
                *columns, pa.array(n_words), pa.array(n_hit),
                pa.array([sorted(x) for x in ids], pa.list_(pa.string())),
                pa.array(spans if locations else [None] * rows, out),
            ],
            names=[f.name for f in schema.fields],
        )

    return map_batches(source, schema, judge)


def item_digest(items: F.Column) -> F.Column:
    return F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256)


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, with the same columns."""
    rows, names = masked(docs)
    judged = matches(
        rows, benchmark, carry=list(names.values()), text_col=names[text_col], locations=False, **options
    )
    return unmasked(judged.filter("n_hit = 0"), names)


def op8_decontamination(spark, sf_dir) -> DataFrame:
    """All documents against all benchmark items, windows of 10 words."""
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), locations=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        item_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select coalesce(item_id::varchar, 'null') as item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
probes as (
  select item_id, w[i : i + 9] as win, 10 as n
  from items, unnest(range(1, greatest(len(w) - 8, 1))) as u(i) where len(w) >= 10
  union all select item_id, w, len(w) from items where len(w) between 1 and 9),
lengths as (select distinct n from probes),
wins as (
  select r, doc_id, i, n, w[i : i + n - 1] as win
  from docs, lengths, unnest(range(1, greatest(len(w) - n + 2, 1))) as u(i) where len(w) >= n),
hits as (select distinct x.r, x.i, x.n, p.item_id from wins x join probes p on x.n = p.n and x.win = p.win),
covered as (select r, count(distinct i + k) as n_hit from hits, unnest(range(0, n)) as v(k) group by r),
named as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id from hits) group by r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit,
  coalesce(m.n_items, 0)::bigint as n_items, sha256(coalesce(m.ids, '')) as items_sha256,
  coalesce(c.n_hit, 0) > 0 as contaminated
from docs d left join covered c using (r) left join named m using (r)
"""
