"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of block-level tags and text blocks (inline tags belong to their block). Repeated
runs of its stream are folded into ``(...)+`` groups, which leaves a short *shape*. Spark counts the
shapes of each host, with the text mass of every slot and whether its text ever changes; pages meet
only as counts, so a host's size does not matter. The shapes of a host are then aligned one after the
other with the host's wrapper (longest common subsequence): equal tags stay, differing text becomes
a slot, and what only one side has becomes an optional group. Hosts with very many shapes are folded
in two levels, as wrappers can be aligned with each other.

Slots of the wrapper are main text unless they lie in a container that is chrome by its tag, class or
id. Where the wrapper has an article or main element, only its slots count; otherwise all others do,
without text that is the same on all pages that have it. That takes ``FEW_PAGES`` pages at least: what
one page alone has, in a group of its own, is its text and no boilerplate.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.frames import map_batches, small_batches, stored, table
from roadlens.llm.urls import host_of

#: Elements of the markup language by their role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base col embed hr input link meta param source track".split())
RAW = frozenset("script style title textarea".split())
CHROME = frozenset(
    "head nav footer aside form script style title textarea noscript template svg select button iframe menu dialog".split()
)
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies"
    " disqus menu modal nav navbar navigation newsletter notice notices popup promo promoted related share sharing"
    " sidebar social sponsor sponsored subscribe toolbar widget".split()
)
PAGE = frozenset(["html", "body"])
#: Words of class names that speak of other parts of the page ("no-sidebar", "has-comments").
SAYS_OF_OTHERS = frozenset(["no", "not", "has", "with", "without", "ok"])
OUTER_CHROME = frozenset(["header", "footer"])
MAIN = frozenset(["article", "main"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAME = re.compile(r"""(?:^|\s)(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_SELF_CLOSING = frozenset(["p", "li"])
MAX_UNIT = 8
#: On so many pages a text has to be the same to be taken for boilerplate.
FEW_PAGES = 3


def stream(page: str) -> tuple[list[str], list[str]]:
    """Block-level tokens of a page (``<tag.class>``, ``</tag>``, ``#`` for text) and the text blocks.

    An open paragraph or list item ends where the next one, or another block, begins or ends.
    """
    tokens: list[str] = []
    texts: list[str] = []
    text: list[str] = []
    open_self: list[str] = []
    at, size = 0, len(page)

    def flush() -> None:
        block = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if block:
            tokens.append("#")
            texts.append(block)

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            text.append(page[at:])
            break
        text.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if page.startswith("<![CDATA[", found.start()):
                text.append(page[found.start() + 9 : at].removesuffix("]]>"))
            continue
        closing = bool(found[1] or found[4])
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            if name in _SELF_CLOSING:
                if open_self and open_self[-1] == name:
                    open_self.pop()
                    tokens.append(f"</{name}>")
                continue
            while open_self:
                tokens.append(f"</{open_self.pop()}>")
            if name not in VOID:
                tokens.append(f"</{name}>")
            continue
        if open_self and (open_self[-1] == name or open_self[-1] == "p"):
            tokens.append(f"</{open_self.pop()}>")
        marks = sorted(
            _DIGITS.sub("0", m)
            for _, a, b, c in _NAME.findall(found[3] or found[6] or "")
            for m in (a or b or c).split()
        )
        tokens.append(f"<{'.'.join([name, *marks])}>")
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            tokens.append(f"</{name}>")
        elif name in _SELF_CLOSING:
            open_self.append(name)
    flush()
    while open_self:
        tokens.append(f"</{open_self.pop()}>")
    return tokens, texts


def fold(tokens: list[str]) -> list[tuple]:
    """The tokens with repeated runs as groups: items (shape, leaves), where leaves lists, for each text
    slot of the shape, the numbers of its text blocks. An element that holds only text is always a
    group, so that one paragraph and many have the same shape."""
    items: list[tuple] = []
    number = 0
    for token in tokens:
        if token == "#":
            items.append(("#", [[number]]))
            number += 1
        else:
            items.append((token, []))
    plain: list[tuple] = []
    i = 0
    while i < len(items):
        if i + 2 < len(items) and items[i + 1][0] == "#" and items[i][0][0] == "<" and items[i + 2][0][:2] == "</":
            plain.append((("+", items[i][0], "#", items[i + 2][0]), items[i + 1][1]))
            i += 3
        else:
            plain.append(items[i])
            i += 1
    items = plain
    changed = True
    while changed:
        changed = False
        for unit in range(1, MAX_UNIT + 1):
            out: list[tuple] = []
            i = 0
            while i < len(items):
                body = [s for s, _ in items[i : i + unit]]
                again = 1
                if len(body) == unit and (unit > 1 or isinstance(body[0], tuple)):
                    while [s for s, _ in items[i + again * unit : i + (again + 1) * unit]] == body:
                        again += 1
                if again == 1:
                    out.append(items[i])
                    i += 1
                    continue
                leaves: list[list[int]] = []
                for k in range(unit):
                    for leaf in range(len(items[i + k][1])):
                        leaves.append([n for r in range(again) for n in items[i + r * unit + k][1][leaf]])
                out.append((body[0] if unit == 1 else ("+", *body), leaves))
                i += again * unit
                changed = True
            items = out
    return items


def _slots(shape) -> int:
    return (shape == "#") if isinstance(shape, str) else sum(_slots(s) for s in shape[1:])


def _same(a: dict, b: dict) -> bool:
    """Items match if they are alike and lie in the same containers."""
    return a["shape"] == b["shape"] and a["path"] == b["path"]


def align(a: list[dict], b: list[dict]) -> list[tuple[int | None, int | None]]:
    """Matched and unmatched items of two wrappers, in order, by longest common subsequence."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            if _same(a[i], b[j]):
                best[i][j] = best[i + 1][j + 1] + 1
            else:
                best[i][j] = max(best[i + 1][j], best[i][j + 1])
    pairs: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < len(a) and j < len(b):
        if _same(a[i], b[j]):
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            pairs.append((i, None))
            i += 1
        else:
            pairs.append((None, j))
            j += 1
    return pairs + [(k, None) for k in range(i, len(a))] + [(None, k) for k in range(j, len(b))]


def merge(a: list[dict], b: list[dict]) -> list[dict]:
    """One wrapper for what both describe; items of one side only become optional."""
    merged = []
    for i, j in align(a, b):
        if i is None or j is None:
            merged.append({**(b[j] if i is None else a[i]), "optional": True})
            continue
        slots = [
            {"chars": x["chars"] + y["chars"], "pages": x["pages"] + y["pages"], "low": min(x["low"], y["low"]), "high": max(x["high"], y["high"])}
            for x, y in zip(a[i]["slots"], b[j]["slots"], strict=True)
        ]
        merged.append({"shape": a[i]["shape"], "path": a[i]["path"], "optional": a[i]["optional"] or b[j]["optional"], "slots": slots})
    return merged


def _changes(slot: dict) -> bool:
    return slot["low"] != slot["high"] or slot["pages"] < FEW_PAGES


def expression(wrapper: list[dict]) -> str:
    """The wrapper as a regular expression over tokens; ``#`` stands for changing text."""

    def text(shape, slots: Iterator[dict]) -> str:
        if shape == "#":
            slot = next(slots)
            return "#" if _changes(slot) else "text"
        return shape if isinstance(shape, str) else "(" + " ".join(text(s, slots) for s in shape[1:]) + ")+"

    parts: list[str] = []
    for item in wrapper:
        own = text(item["shape"], iter(item["slots"]))
        if not item["optional"]:
            parts.append(own)
        elif parts and parts[-1].endswith(")?"):
            parts[-1] = f"{parts[-1][:-2]} {own})?"
        else:
            parts.append(f"({own})?")
    return " ".join(parts)


def _walk(shape, stack: list[str], found: list[tuple[str, ...]]) -> None:
    """Follows the tags of a shape on the stack of open containers; notes the stack at every slot."""
    if not isinstance(shape, str):
        for s in shape[1:]:
            _walk(s, stack, found)
    elif shape == "#":
        found.append(tuple(stack))
    elif shape[:2] == "</":
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].split(".")[0] == shape[2:-1]:
                del stack[k:]
                break
    elif shape[1:-1].split(".")[0] not in VOID:
        stack.append(shape[1:-1])


def _paths(wrapper: list[dict]) -> list[tuple[str, ...]]:
    """The open containers at every slot of a wrapper, outermost first."""
    found: list[tuple[str, ...]] = []
    for item in wrapper:
        _walk(item["shape"], list(item["path"]), found)
    return found


def _class_words(name: str, marks: list[str]) -> set[str]:
    """The words of an element's classes that may tell what it is. The page itself has classes for what is
    elsewhere on it, an article for its kind; a name that says what is there or not there is no name of the part."""
    if name in PAGE:
        return set()
    lowered = [m.lower() for m in marks]
    if name in MAIN:
        return set(lowered)
    parts = [set(re.split(r"[^a-z]+", m)) for m in lowered]
    return {w for p in parts if not p & SAYS_OF_OTHERS for w in p}


def _is_chrome(path: tuple[str, ...]) -> bool:
    inside = False
    for element in path:
        name, *marks = element.split(".")
        words = _class_words(name, marks)
        if name in CHROME or words & CHROME_WORDS:
            return True
        if not inside and (name in OUTER_CHROME or words & OUTER_CHROME):
            return True
        inside = inside or name in MAIN
    return False


def main_slots(wrapper: list[dict]) -> list[bool]:
    """Which slots of a wrapper hold main text."""
    paths = _paths(wrapper)
    slots = [slot for item in wrapper for slot in item["slots"]]
    free = [not _is_chrome(p) for p in paths]
    in_main = [f and any(e.split(".")[0] in MAIN for e in p) for f, p in zip(free, paths, strict=True)]
    if any(in_main):
        return in_main
    # blocks of one article lie side by side in several containers, so no container is left out
    changing = [f and _changes(s) for f, s in zip(free, slots, strict=True)]
    return changing if any(changing) else free


def _shape_of(page: str) -> tuple[str, list, list[str]]:
    tokens, texts = stream(page)
    items = fold(tokens)
    return json.dumps([s for s, _ in items]), items, texts


def _digest(shape: str) -> bytes:
    return xxhash.xxh3_128_digest(shape.encode())


def shapes(pages: DataFrame) -> DataFrame:
    """Distinct shapes of every host with, per text slot, characters, pages and the range of its text hashes.

    A slot whose range is one value has the same text everywhere.
    """
    small_batches(pages.sparkSession)
    schema = "host string, digest binary, shape string, slot int, chars long, pages long, low long, high long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], list[list[int]]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                shape, items, texts = _shape_of(page or "")
                leaves = [leaf for _, own in items for leaf in own]
                sums = seen.setdefault((host, shape), [[0, 0, (1 << 63) - 1, -(1 << 63)] for _ in leaves])
                for total, leaf in zip(sums, leaves, strict=True):
                    whole = xxhash.xxh3_64_intdigest("\n".join(texts[i] for i in leaf).encode()) - (1 << 63)
                    total[0] += sum(len(texts[i]) for i in leaf)
                    total[1] += 1
                    total[2], total[3] = min(total[2], whole), max(total[3], whole)
            rows = [
                (host, _digest(shape), shape, slot, *total)
                for (host, shape), sums in seen.items()
                for slot, total in enumerate(sums or [[0, 0, 0, 0]])
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, t)
                        for c, t in zip(
                            zip(*rows, strict=True),
                            (pa.string(), pa.binary(), pa.string(), pa.int32(), *[pa.int64()] * 4),
                            strict=True,
                        )
                    ],
                    names=["host", "digest", "shape", "slot", "chars", "pages", "low", "high"],
                )

    seen = pages.mapInArrow(count, schema).groupBy("host", "digest", "slot").agg(
        F.first("shape").alias("shape"), F.sum("chars").alias("chars"), F.sum("pages").alias("pages"),
        F.min("low").alias("low"), F.max("high").alias("high")
    )
    slots = F.array_sort(F.collect_list(F.struct("slot", "chars", "pages", "low", "high")))
    return seen.groupBy("host", "digest").agg(F.first("shape").alias("shape"), slots.alias("slots"))


def _wrapper_of(shape: str, slots) -> list[dict]:
    left = iter(slots)
    stack: list[str] = []
    items = []
    for own in map(_thawed, json.loads(shape)):
        totals = [{k: int(v[k]) for k in ("chars", "pages", "low", "high")} for v in (next(left) for _ in range(_slots(own)))]
        items.append({"shape": own, "path": tuple(stack), "optional": False, "slots": totals})
        _walk(own, stack, [])
    return items


def _thawed(shape):
    return shape if isinstance(shape, str) else tuple(_thawed(s) for s in shape)


def infer(found: DataFrame, spread: int = 16) -> DataFrame:
    """The wrapper of every host (host, wrapper as JSON, expression) from its distinct shapes."""

    def combine(wrappers: list[list[dict]]) -> str:
        wrappers.sort(key=lambda w: (-sum(s["chars"] for i in w for s in i["slots"]), json.dumps([i["shape"] for i in w])))
        whole = wrappers[0]
        for other in wrappers[1:]:
            whole = merge(whole, other)
        return json.dumps(whole)

    def first(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "host": group["host"].iloc[:1],
                "wrapper": [combine([_wrapper_of(a, b) for a, b in zip(group["shape"], group["slots"], strict=True)])],
            }
        )

    def second(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = combine([_loaded(w) for w in group["wrapper"]])
        return pd.DataFrame(
            {"host": group["host"].iloc[:1], "wrapper": [wrapper], "expression": [expression(_loaded(wrapper))]}
        )

    parted = found.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(spread)))
    halves = parted.groupBy("host", "part").applyInPandas(first, "host string, wrapper string")
    return halves.groupBy("host").applyInPandas(second, "host string, wrapper string, expression string")


def _loaded(wrapper: str) -> list[dict]:
    return [{**item, "shape": _thawed(item["shape"]), "path": tuple(item["path"])} for item in json.loads(wrapper)]


def marked(found: DataFrame, wrappers: DataFrame) -> DataFrame:
    """For each shape of a host the text slots that are main text (host, digest, main)."""

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flags = []
        for shape, slots, wrapper in zip(
            batch.column("shape").to_pylist(), batch.column("slots").to_pylist(), batch.column("wrapper").to_pylist(),
            strict=True,
        ):
            own, whole = _wrapper_of(shape, slots), _loaded(wrapper)
            chosen = iter(main_slots(whole))
            of_item = [[next(chosen) for _ in item["slots"]] for item in whole]
            main = []
            for i, j in align(own, whole):
                if i is not None:
                    main.extend(of_item[j] if j is not None else [False] * len(own[i]["slots"]))
            flags.append(main if any(main) else main_slots(own))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("digest"), pa.array(flags, pa.list_(pa.bool_()))],
            names=["host", "digest", "main"],
        )

    both = found.join(wrappers.select("host", "wrapper"), "host").select("host", "digest", "shape", "slots", "wrapper")
    return map_batches(both, "host string, digest binary, main array<boolean>", mark)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text (main blocks joined by line ends) and n_chars.

    Null html is an empty page with empty text; null or odd urls share the empty host. Repeated rows
    are extracted one by one. An empty table gives an empty result.
    """
    named = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        host_of(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html"),
    )
    found = stored(shapes(named.select("host", "html")), "page-shapes")
    chosen = stored(marked(found, infer(found)), "page-slots")

    def shape(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        digests, blocks = [], []
        for page in batch.column("html").to_pylist():
            own, items, texts = _shape_of(page or "")
            leaf_of = {i: n for n, leaf in enumerate(x for _, leaves in items for x in leaves) for i in leaf}
            digests.append(_digest(own))
            blocks.append([{"slot": leaf_of[i], "text": t} for i, t in enumerate(texts)])
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(digests, pa.binary()), pa.array(blocks, kind)],
            names=["page_id", "url", "host", "digest", "blocks"],
        )

    kind = dict(named.dtypes)["page_id"]
    schema = f"page_id {kind}, url string, host string, digest binary, blocks array<struct<slot:int,text:string>>"
    rows = map_batches(named, schema, shape)
    main = F.filter("blocks", lambda b: F.element_at("main", b["slot"] + 1))
    text = F.array_join(F.transform(main, lambda b: b["text"]), "\n")
    return (
        rows.join(chosen, ["host", "digest"], "left")
        .withColumn("text", F.coalesce(text, F.lit("")))
        .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
    )


def op9_extraction(spark, sf_dir) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
