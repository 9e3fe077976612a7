"""Secret scans: patterns of known secrets, and strings a tokenizer finds hard to spell.

Text that was written by people falls into few tokens of a vocabulary learned from such text; random
strings fall into many. Every long run of letters, digits and ``+/_=-`` whose characters per token lie
below ``MIN_RATIO`` is reported, unless it is a digest of a known length, a UUID, a number, or an
identifier: parts joined by ``-_/=+`` of which each is a number, one token, or at ``MIN_RATIO`` by itself.
Runs of letters alone are tested like all others.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.frames import map_batches, table

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST = re.compile(r"([0-9a-f]+|[0-9A-F]+)")
#: Hexadecimal lengths of common digests.
DIGEST_LENGTHS = frozenset([32, 40, 56, 64, 96, 128])
MIN_ASSIGNED, MIN_ACCESS = 6, 20
MIN_RATIO = 2.2
KINDS = ("assign", "access", "hex", "random")


@lru_cache(maxsize=4)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def is_identifier(run: str, encoding, min_ratio: float = MIN_RATIO) -> bool:
    """Digests, UUIDs, numbers, and numbers or parts of few tokens joined by separators."""
    if UUID.fullmatch(run) or (len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run)):
        return True
    for part in filter(None, re.split(r"[-_/=+]+", run)):
        tokens = 1 if part.isdigit() else len(encoding.encode_ordinary(part))
        if tokens > 1 and len(part) / tokens < min_ratio:
            return False
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The spans of known patterns as (start, kind, end)."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, known: list[tuple[int, int, int]], encoding, min_ratio: float = MIN_RATIO):
    """Hard-to-spell runs that no known span covers, as (start, kind, end)."""
    for m in RUN.finditer(text):
        run = m[0]
        if any(start <= m.start() and m.end() <= end for start, _, end in known):
            continue
        if len(run) / len(encoding.encode_ordinary(run)) < min_ratio and not is_identifier(run, encoding, min_ratio):
            yield m.start(), 3, m.end()


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_random, base_spans and spans.

    Spans are ``kind:start:end`` in code points, by start, then kind. ``vocabulary`` is the path of a
    tiktoken file that every executor can read. Null text is empty text; repeated rows are scanned one by one; an empty
    table gives an empty result.
    """
    path = vocabulary or default_vocabulary()
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        counts, base, every = [], [], []
        for text in batch.column("text").to_pylist():
            known = base_spans(text or "")
            more = list(random_spans(text or "", known, encoding, min_ratio))
            kinds = [kind for _, kind, _ in known]
            counts.append([*(kinds.count(k) for k in range(3)), len(more)])
            base.append(_joined(known))
            every.append(_joined(known + more))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)],
                pa.array(base, pa.string()), pa.array(every, pa.string()),
            ],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"],
        )

    kind = dict(named.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string"
    return map_batches(named, schema, find)


def op4_secrets(spark, sf_dir) -> DataFrame:
    """All documents; the known spans as a digest, all spans spelled out."""
    found = scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("base_spans", "UTF-8"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest.alias("base_sha256"), "spans", "n_random")
