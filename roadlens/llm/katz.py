"""Language-model scoring: a bigram model with Katz backoff and Good-Turing discounts.

The corpus is cut into *chunks* of some 800 000 tokens, each a row with its own vocabulary and tokens
as packed arrays. All counting and lookups are exchanges between chunks and *parts*: a chunk sends its
distinct words, or word pairs, once to the part that owns them, and gets their corpus counts back in
the same order. So what is shuffled are distinct n-grams of a chunk, not tokens, and no n-gram, however
frequent, has more than one entry per chunk.

1. Words go to parts by hash range; parts answer with training counts and count the counts.
2. Pairs go to parts by context, so a part sees all that follows a context. A context with more tokens
   than the average part (there are fewer of those than parts) goes to parts by pair instead, and its sums
   are put together afterwards. Parts answer with pair counts, and per context with what its
   backoff weight is made of: how many pairs occur 1 to 5 times, the tokens of the others, and the
   unigram probability of all seen followers.
3. Each chunk evaluates its tokens: the discounted pair, else backoff weight times the discounted word,
   else the mass left for unknown words. Backoff weights normalise exactly: the mass that discounting
   took from a context over the unigram mass of the words not seen after it.

A context from which nothing was discounted gets one more in its denominator, so unseen followers
have a probability; the same holds for the words. Chunks are kept in a table bucketed by chunk, so
answers come to them without moving the tokens again. An answer stays a row of its own until it meets its
chunk in a cogroup: a row with all answers to a chunk would be as large as the chunk's n-grams, and a JVM
holds such a row once for each sort, join and aggregate it passes. Counts travel compressed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm import kernels
from roadlens.llm.frames import small_batches, stored, table

CHUNK_TOKENS = 800_000
PART_TOKENS = 1_000_000
DISCOUNTED = 5
FOLDS = 5
HELD_OUT = 1
#: Hashes of the two marks, as words have them.
START, END = (kernels.mix(np.array([x], dtype=np.uint64))[0] for x in (0x53, 0x45))


def pack(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of whole numbers, byte by byte in planes, compressed; their number is ahead."""
    whole = np.ascontiguousarray(values.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8)
    return len(values).to_bytes(8, "little") + pa.compress(whole[:, :width].T.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes | pa.Buffer, width: int) -> np.ndarray:
    data = pa.py_buffer(data)
    size = int.from_bytes(data.slice(0, 8), "little")
    planes = np.frombuffer(pa.decompress(data.slice(8), size * width, "zstd"), dtype=np.uint8).reshape(width, size)
    whole = np.zeros((size, 8), dtype=np.uint8)
    whole[:, :width] = planes.T
    return whole.view("<u8").ravel()


def cells(column: pa.Array | pa.ChunkedArray) -> list[pa.Buffer]:
    """The values of a binary column where Arrow has them, not copied."""
    return [x.as_buffer() for x in column]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts as ranges of the hash, so that sorted hashes have their parts in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discount ratios for counts 0 to 5, from the numbers of types seen 0 to 6 times.

    1 where the counts of counts give none between 0 and 1.
    """
    ratio = np.ones(DISCOUNTED + 1)
    if n[1] <= 0:
        return ratio
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
    for r in range(1, DISCOUNTED + 1):
        if n[r] > 0 and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            if 0 < d < 1:
                ratio[r] = d
    return ratio


@dataclass
class Unigrams:
    """Training tokens, distinct training tokens, and the discounted word distribution."""

    tokens: int
    types: int
    ratio: np.ndarray
    total: float
    unknown: float

    @classmethod
    def of(cls, tokens: int, types: int, n: np.ndarray) -> Unigrams:
        ratio = discounts(n)
        left = float(((1 - ratio[1:]) * np.arange(1, DISCOUNTED + 1) * n[1 : DISCOUNTED + 1]).sum())
        total = tokens + (left == 0)
        return cls(tokens, types, ratio, float(total), (left or 1.0) / total)

    def probability(self, count: np.ndarray) -> np.ndarray:
        kept = count * self.ratio[np.where(count <= DISCOUNTED, count, 0)]
        return np.where(count > 0, kept / self.total, self.unknown)


@dataclass
class Chunk:
    """Documents with their tokens as indices into the chunk's vocabulary (hashes, frequent ones first)."""

    number: int
    ids: pa.Array
    train: np.ndarray
    sizes: np.ndarray
    vocabulary: np.ndarray
    tokens: np.ndarray

    @classmethod
    def read(cls, row: pa.RecordBatch | pa.Table) -> Chunk:
        """The chunk of a single row."""
        train, sizes, vocabulary, tokens = (
            cells(row.column(name))[0] for name in ("train", "sizes", "vocabulary", "tokens")
        )
        return cls(
            row.column("chunk")[0].as_py(), row.column("doc_id")[0].values,
            np.frombuffer(train, dtype=bool), np.frombuffer(sizes, dtype=np.int64),
            np.frombuffer(vocabulary, dtype=np.uint64), unpack(tokens, 4).view(np.int64),
        )

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of every token, the end of each document included. The start mark and the
        end mark have the index after the vocabulary."""
        mark = len(self.vocabulary)
        place = np.arange(len(self.tokens)) + np.repeat(np.arange(len(self.sizes)), self.sizes)
        context = np.full(len(self.tokens) + len(self.sizes), mark)
        word = context.copy()
        context[place + 1 if len(place) else place] = self.tokens
        starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        context[starts] = mark
        word[place] = self.tokens
        return context, word

    def token_rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes + 1)


@dataclass
class Pairs:
    """Distinct pairs of a chunk in the order in which parts get them."""

    inverse: np.ndarray
    context: np.ndarray
    word: np.ndarray
    part: np.ndarray

    @classmethod
    def of(cls, chunk: Chunk, counts: np.ndarray, documents: int, parts: int, limit: float) -> Pairs:
        key, word = chunk.pairs()
        key <<= 32
        key |= word
        del word
        key, inverse = np.unique(key, return_inverse=True)
        inverse = inverse.astype(np.int32)
        context, word = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
        del key
        owner = np.append(chunk.vocabulary, START)[context]
        hot = np.flatnonzero(np.append(counts, documents)[context] > limit)
        by_word = np.append(chunk.vocabulary, END)[word[hot]]
        owner[hot] = kernels.mix(owner[hot] ^ (by_word * np.uint64(0x9E3779B97F4A7C15)))
        part = part_of(owner, parts).astype(np.int32)
        del owner, hot, by_word
        order = np.argsort(part, kind="stable")
        back = np.empty(len(order), dtype=np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        return cls(back[inverse], context[order], word[order], part[order])


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk. ``train`` says whether a document's fold is not the held-out one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made, size = 0, 0
        ids, train, sizes, hashes = [], [], [], []

        def close() -> pa.RecordBatch:
            nonlocal made, size, ids, train, sizes, hashes
            words = np.concatenate(hashes)
            known, inverse, count = np.unique(words, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 24) + made]), pa.array([ids], pa.list_(pa.int64())),
                    *[
                        pa.array([x], pa.binary())
                        for x in (
                            np.concatenate(train).astype(bool).tobytes(), np.concatenate(sizes).tobytes(),
                            known[order].tobytes(), pack(rank[inverse], 4),
                        )
                    ],
                ],
                names=["chunk", "doc_id", "train", "sizes", "vocabulary", "tokens"],
            )
            made, size = made + 1, 0
            ids, train, sizes, hashes = [], [], [], []
            return row

        for batch in batches:
            names, fold = batch.column("doc_id").to_pylist(), batch.column("fold").to_numpy()
            for block in kernels.blocks(batch.column("text")):
                w = kernels.words(block, kernels.LOWERED)
                here = slice(block.first, block.first + block.rows)
                ids.extend(names[here])
                train.append(fold[here] != HELD_OUT)
                sizes.append(np.diff(kernels.row_bounds(w.row, block.rows)))
                hashes.append(w.hash)
                size += len(w.hash) + block.rows
                if size >= CHUNK_TOKENS:
                    yield close()
        if size:
            yield close()

    schema = "chunk long, doc_id array<long>, train binary, sizes binary, vocabulary binary, tokens binary"
    fold = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(FOLDS))
    read = docs.select("doc_id", F.coalesce(fold, F.lit(0)).cast("int").alias("fold"), "text")
    return read.mapInArrow(cut, schema)


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    spark = df.sparkSession
    name = f"katz_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    df.write.option("compression", "zstd").bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def _met(kept: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` of every chunk and the answers to it. The chunks stay where their buckets are."""

    def meet(chunk: pa.Table, answered: pa.Table) -> pa.Table:
        made = fn(chunk, answered)
        pa.default_memory_pool().release_unused()
        return made

    return kept.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(meet, schema)


def _in_order(answers: pa.Table, of_words: bool, *names: str) -> list[list[pa.Buffer]]:
    """Columns of the answers about words, or about pairs, in the order of the parts."""
    answers = answers.filter(pc.equal(answers.column("of_words"), of_words))
    order = np.argsort(answers.column("part").to_numpy())
    columns = [cells(answers.column(name)) for name in names]
    return [[column[i] for i in order] for column in columns]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows one by one; what Arrow keeps of those that are done goes back to the system."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)
            pa.default_memory_pool().release_unused()


def count_words(kept: DataFrame, parts: int) -> tuple[DataFrame, np.ndarray]:
    """Training counts of every chunk's words in the order of their hashes, and the sums over all
    parts: how many words occur 0 to 6 times, distinct words, words in all."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk.read(row)
            used = np.bincount(chunk.tokens, weights=np.repeat(chunk.train, chunk.sizes), minlength=len(chunk.vocabulary))
            order = np.argsort(chunk.vocabulary)
            words, used = chunk.vocabulary[order], used[order].astype(np.int64)
            edges = np.searchsorted(part_of(words, parts), np.arange(parts + 1))
            for p in range(parts):
                own = slice(edges[p], edges[p + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.number]), pa.array([p], pa.int32()),
                        pa.array([words[own].tobytes()], pa.binary()), pa.array([pack(used[own], 4)], pa.binary()),
                    ],
                    names=["chunk", "part", "words", "used"],
                )

    def answer(asked: pa.Table) -> pa.Table:
        words = [np.frombuffer(x, dtype=np.uint64) for x in cells(asked.column("words"))]
        used = np.concatenate([unpack(x, 4) for x in cells(asked.column("used"))])
        edges = np.cumsum([0, *[len(x) for x in words]])
        known, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, weights=used, minlength=len(known)).astype(np.int64)
        seen = np.bincount(np.minimum(total, 7), minlength=8)[:7]
        sums = np.concatenate([seen, [(total > 0).sum(), total.sum()]]).astype(np.int64)
        found = total[place]
        return pa.table(
            {
                "chunk": pa.array([*asked.column("chunk").to_pylist(), -1], pa.int64()),
                "part": pa.array([asked.column("part")[0].as_py()] * (len(words) + 1), pa.int32()),
                "counts": pa.array(
                    [*[pack(found[a:b], 6) for a, b in zip(edges, edges[1:], strict=False)], sums.tobytes()], pa.binary()
                ),
            }
        )

    asked = kept.select("chunk", "doc_id", "train", "sizes", "vocabulary", "tokens").mapInArrow(
        ask, "chunk long, part int, words binary, used binary"
    )
    answers = stored(
        asked.groupBy("part").applyInArrow(answer, "chunk long, part int, counts binary"), "katz-words", "zstd"
    )
    sums = np.zeros(9, dtype=np.int64)
    for (row,) in answers.filter("chunk = -1").select("counts").collect():
        sums += np.frombuffer(row, dtype=np.int64)
    return answers.filter("chunk >= 0").withColumn("of_words", F.lit(True)), sums


def _word_counts(chunk: Chunk, answers: pa.Table) -> np.ndarray:
    counts = np.empty(len(chunk.vocabulary), dtype=np.int64)
    (found,) = _in_order(answers, True, "counts")
    counts[np.argsort(chunk.vocabulary)] = np.concatenate([unpack(x, 6) for x in found])
    return counts


def count_pairs(
    kept: DataFrame, words: DataFrame, unigrams: Unigrams, documents: int, parts: int
) -> tuple[DataFrame, np.ndarray, dict[int, np.ndarray]]:
    """Training counts of every chunk's pairs and the sums of its contexts, how many pairs occur 0 to 6
    times, and the sums of the contexts that are spread over all parts."""
    limit = unigrams.tokens / parts

    def ask(row: pa.Table, answered: pa.Table) -> pa.Table:
        chunk = Chunk.read(row)
        counts = _word_counts(chunk, answered)
        pairs = Pairs.of(chunk, counts, documents, parts, limit)
        used = np.bincount(pairs.inverse, weights=chunk.train[chunk.token_rows()], minlength=len(pairs.context))
        by_context, by_word = np.append(chunk.vocabulary, START), np.append(chunk.vocabulary, END)
        of_any = np.append(counts, documents)
        edges = np.searchsorted(pairs.part, np.arange(parts + 1))
        made = []
        for p in np.flatnonzero(np.diff(edges)):
            own = slice(edges[p], edges[p + 1])
            context, word = pairs.context[own], pairs.word[own]
            first = np.flatnonzero(np.diff(context, prepend=-1))
            runs = np.diff(np.append(first, len(context)))
            made.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.number]), pa.array([p], pa.int32()),
                        *[
                            pa.array([x], pa.binary())
                            for x in (
                                by_context[context[first]].tobytes(), (of_any[context[first]] > limit).tobytes(),
                                pack(runs, 4), pack(by_word[word], 6), pack(used[own], 4), pack(of_any[word], 6),
                            )
                        ],
                    ],
                    names=["chunk", "part", "contexts", "hot", "runs", "words", "used", "of_word"],
                )
            )
        return pa.Table.from_batches(made)

    def answer(asked: pa.Table) -> pa.Table:
        def column(name: str, width: int) -> list[np.ndarray]:
            return [unpack(x, width) for x in cells(asked.column(name))]

        contexts = [np.frombuffer(x, dtype=np.uint64) for x in cells(asked.column("contexts"))]
        runs = column("runs", 4)
        sizes = [int(r.sum()) for r in runs]
        context = np.concatenate([np.repeat(c, r.astype(np.int64)) for c, r in zip(contexts, runs, strict=True)])
        key = kernels.mix(context * np.uint64(0xD1342543DE82EF95) + np.concatenate(column("words", 6)))
        known, first, place = np.unique(key, return_index=True, return_inverse=True)
        del key
        total = np.bincount(place, weights=np.concatenate(column("used", 4)), minlength=len(known)).astype(np.int64)
        seen = np.bincount(np.minimum(total, 7), minlength=8)[:7]
        # per context: pairs seen 1 to 5 times, tokens of the others, unigram mass of all that were seen
        all_contexts, of = np.unique(context[first], return_inverse=True)
        del context
        size = len(all_contexts)
        sums = np.zeros((7, size))
        for r in range(1, DISCOUNTED + 1):
            sums[r - 1] = np.bincount(of[total == r], minlength=size)
        many = total > DISCOUNTED
        sums[5] = np.bincount(of[many], weights=total[many], minlength=size)
        some = total > 0
        followers = np.concatenate(column("of_word", 6))[first].astype(np.int64)
        sums[6] = np.bincount(of[some], weights=unigrams.probability(followers[some]), minlength=size)
        found = total[place]
        edges = np.cumsum([0, *sizes])
        rows = [
            (pack(found[a:b], 4), pack(sums[:6, at].astype(np.int64).ravel(), 6), sums[6, at].tobytes())
            for a, b, at in zip(
                edges, edges[1:], (np.searchsorted(all_contexts, c) for c in contexts), strict=False
            )
        ]
        hot = np.unique(
            np.concatenate(
                [c[np.frombuffer(h, dtype=bool)] for c, h in zip(contexts, cells(asked.column("hot")), strict=True)]
            )
        )
        at = np.searchsorted(all_contexts, hot)
        rows.append((hot.tobytes(), sums[:, at].tobytes(), seen.astype(np.int64).tobytes()))
        return pa.table(
            {
                "chunk": pa.array([*asked.column("chunk").to_pylist(), -1], pa.int64()),
                "part": pa.array([asked.column("part")[0].as_py()] * len(rows), pa.int32()),
                **{n: pa.array([r[i] for r in rows], pa.binary()) for i, n in enumerate(("counts", "sums", "mass"))},
            }
        )

    schema = "chunk long, part int, contexts binary, hot binary, runs binary, words binary, used binary, of_word binary"
    asked = _met(kept, words, ask, schema)
    answers = stored(
        asked.groupBy("part").applyInArrow(answer, "chunk long, part int, counts binary, sums binary, mass binary"),
        "katz-pairs", "zstd",
    )
    seen = np.zeros(7, dtype=np.int64)
    hot: dict[int, np.ndarray] = {}
    for contexts, sums, n in answers.filter("chunk = -1").select("counts", "sums", "mass").collect():
        seen += np.frombuffer(n, dtype=np.int64)
        names = np.frombuffer(contexts, dtype=np.uint64)
        for name, own in zip(names.tolist(), np.frombuffer(sums).reshape(7, -1).T, strict=True):
            hot[name] = hot.get(name, 0) + own
    return answers.filter("chunk >= 0").withColumn("of_words", F.lit(False)), seen, hot


def context_weights(sums: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and backoff weight of contexts from their sums (columns). 1 where none was seen."""
    times = np.arange(1, DISCOUNTED + 1)
    tokens = (sums[:5] * times[:, None]).sum(axis=0) + sums[5]
    left = (sums[:5] * (times * (1 - ratio[1:]))[:, None]).sum(axis=0)
    bare = (left == 0) & (tokens > 0)
    total = tokens + bare
    weight = np.ones(len(tokens))
    some = tokens > 0
    weight[some] = (left + bare)[some] / total[some] / (1 - sums[6, some])
    return total, weight


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 of the model's probability of the text).

    Null and empty texts are one token, their end. A null id is never held out. Repeated rows are all
    counted and scored. Ids are cast to long. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kept = _bucketed(chunks(named), "chunk")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            train = np.frombuffer(cells(row.column("train"))[0], dtype=bool)
            sizes = np.frombuffer(cells(row.column("sizes"))[0], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(train.sum())]), pa.array([int(sizes.sum() + len(sizes))])], names=["documents", "tokens"]
            )

    documents, everything = (
        kept.select("train", "sizes").mapInArrow(count, "documents long, tokens long").agg(F.sum("documents"), F.sum("tokens")).first()
    )
    documents = documents or 0
    parts = max(1, -(-(everything or 0) // PART_TOKENS))
    words, sums = count_words(kept, parts)
    n = sums[:7].astype(float)
    if 1 <= documents <= 6:
        n[documents] += 1
    unigrams = Unigrams.of(int(sums[8]) + documents, int(sums[7]) + (documents > 0), n)
    pairs, seen, hot = count_pairs(kept, words, unigrams, documents, parts)
    ratio = discounts(seen.astype(float))
    limit = unigrams.tokens / parts
    names = np.array(sorted(hot), dtype=np.uint64)
    hot_sums = np.array([hot[x] for x in names.tolist()]).reshape(-1, 7).T

    def evaluate(row: pa.Table, answered: pa.Table) -> pa.Table:
        chunk = Chunk.read(row)
        counts = _word_counts(chunk, answered)
        pair = Pairs.of(chunk, counts, documents, parts, limit)
        found, sums, mass = _in_order(answered, False, "counts", "sums", "mass")
        # sums of each context, in the order of its runs
        first = np.flatnonzero((np.diff(pair.context, prepend=-1) != 0) | (np.diff(pair.part, prepend=-1) != 0))
        own = np.empty((7, len(first)))
        at = 0
        for whole, rest in zip(sums, mass, strict=True):
            end = at + rest.size // 8
            own[:6, at:end] = unpack(whole, 6).reshape(6, -1)
            own[6, at:end] = np.frombuffer(rest)
            at = end
        of_any = np.append(counts, documents)
        spread = of_any[pair.context[first]] > limit
        if spread.any():
            name = np.append(chunk.vocabulary, START)[pair.context[first[spread]]]
            own[:, spread] = hot_sums[:, np.searchsorted(names, name)]
        total, weight = context_weights(own, ratio)
        del own
        run = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(pair.context))))
        times = np.concatenate([unpack(x, 4) for x in found]).view(np.int64)
        of_word = of_any[pair.word]
        new = weight[run] * unigrams.probability(of_word)
        seen_share = times * ratio[np.where(times <= DISCOUNTED, times, 0)] / np.maximum(total[run], 1)
        logs = np.log10(np.where(times > 0, seen_share, new))
        del run, times, new, seen_share
        base = np.log10((of_word + 0.5) / (unigrams.tokens + 0.5 * (unigrams.types + 1)))
        edges = np.cumsum(chunk.sizes + 1) - chunk.sizes - 1

        def per_row(values: np.ndarray) -> np.ndarray:
            """Sums over the tokens of each document, from values of the pairs."""
            return np.add.reduceat(values[pair.inverse], edges)

        return pa.table(
            {
                "doc_id": chunk.ids, "held_out": pa.array(~chunk.train), "n_tokens": pa.array(chunk.sizes + 1),
                "n_known": pa.array(per_row((of_word > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(chunk.sizes), unigrams.tokens, dtype=np.int64)),
                "base_score": pa.array(per_row(base)), "score": pa.array(per_row(logs)),
            }
        )

    return _met(
        kept, words.unionByName(pairs, allowMissingColumns=True), evaluate,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def op6_scoring(spark, sf_dir) -> DataFrame:
    """All documents, learning from four folds of five."""
    return score(table(spark, sf_dir, "documents"))
