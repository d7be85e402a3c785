"""Evaluation texts leaking into training text.

A document contains an item if it repeats ``WINDOW`` consecutive words of it with at most ``EDITS`` of them replaced,
dropped or inserted. Of such a window at least ``SEED`` consecutive words are untouched, so all runs of ``SEED``
item words are sought with a Wu-Manber multi-pattern search whose letters are words: a shift table over blocks of two
words skips the positions where no pattern can end, the block that ends a pattern selects its bucket, and the words
are then compared directly. Each occurrence is verified by extending it in both directions with edits (furthest
reaching words per number of edits), which is exact.

Case, accents, punctuation, spacing, invisible characters, line breaks and markup are removed from both texts; a
number with its separators is one word, and so is a word with its apostrophes or hyphens.

The items are the stated query set: they are searched in blocks of ``ITEM_BLOCK`` items or ``ITEM_CHARS`` characters,
whichever comes first, so that a block's tables fit a task's memory; all documents are scanned whole for each block. A
longer item is a block of its own. A block's tables are built once per Python worker. No document text is shuffled.

Defined results: null or empty texts contain nothing; items of fewer than ``WINDOW`` words cannot be contained; rows
with a null id are reported under null; repeated rows are reported once; empty tables give an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, EDITS = 20, 2
#: Untouched words next to each other that a window with so many edits still has.
SEED = (WINDOW - EDITS) // (EDITS + 1)
#: Items, and characters of items, whose search tables one pass holds; about 1 KB for a word.
ITEM_BLOCK, ITEM_CHARS = 1_000, 1_000_000

_BREAKING = re.compile(r"</?(?:p|br|div|li|ul|ol|tr|td|th|table|h[1-6]|hr|pre|blockquote)\b[^<>]*+>", re.I)
_INLINE = re.compile(r"</?[a-zA-Z][^<>]*+>")
_JOINED = re.compile(r"[.,'’`´‘ʼ\-‐‑](?:(?<=\d[.,])(?=\d)|(?<=\w['’`´‘ʼ\-‐‑])(?=\w))")
_MARKS = re.compile("[\u0300-\u036f]+")
#: Letters of scripts with combining marks of their own.
_MARKED_SCRIPTS = re.compile("[\u0483-\u1fff\u20d0-\u20f0\u3099\u309a\ua66f-\uabff\ufb1e\ufe20-\ufe2f\U00010000-\U0001ffff]")
_NUMBERED = re.compile(r"^[ \t]*\d{1,3}\)\s", re.M)
_WORD = re.compile(r"[^\W_]+")
_HAN = re.compile(r"([㐀-鿿豈-﫿])")
_HIDDEN = re.compile("[\u00ad\u180e\ufeff\u200b-\u200f\u202a-\u202e\u2060-\u206f]+")


def words(text: str | None) -> list[str]:
    """The words that count when texts are compared."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _HIDDEN.sub("", text)))
        if _MARKED_SCRIPTS.search(text):
            text = "".join(c for c in text if not unicodedata.combining(c))
        if _HAN.search(text):
            text = _HAN.sub(r" \1 ", text)
    if "<" in text:
        text = _INLINE.sub("", _BREAKING.sub(" ", text))
    if ")" in text:
        text = _NUMBERED.sub(" ", text)
    return _WORD.findall(_JOINED.sub("", text.replace("**", "").replace("__", "")).casefold())


class Patterns:
    """Shift table, suffix buckets and the items' words."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items = [(i, w) for i, t in items if len(w := words(t)) >= WINDOW]
        self.shift: dict[tuple[str, str], int] = {}
        self.buckets: dict[tuple[str, str], dict[tuple[str, ...], list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for n, (_, w) in enumerate(self.items):
            for at in range(len(w) - SEED + 1):
                run = tuple(w[at : at + SEED])
                for j in range(1, SEED):
                    block = (run[j - 1], run[j])
                    self.shift[block] = min(self.shift.get(block, SEED - 1), SEED - 1 - j)
                self.buckets[run[-2:]][run].append((n, at))
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def occurrences(self, doc: list[str]) -> Iterator[tuple[int, int, int]]:
        """Item number, position in the item and in ``doc`` of every run of ``SEED`` common words."""
        shift, buckets, far, i, end = self.shift, self.buckets, SEED - 1, SEED - 1, len(doc)
        while i < end:
            block = (doc[i - 1], doc[i])
            step = shift.get(block, far)
            if step:
                i += step
                continue
            start = i - SEED + 1
            for n, at in buckets[block].get(tuple(doc[start : i + 1]), ()):
                yield n, at, start
            i += 1

    def contained(self, text: str | None) -> list[tuple[int | None, int]]:
        """The items in ``text`` with their longest repeated stretch, in words of the item."""
        doc = words(text)
        best: dict[int, int] = {}
        ends: dict[tuple[int, int], int] = {}
        for n, at, start in self.occurrences(doc):
            line = (n, at - start)
            if ends.get(line, -1) >= start:  # within a run that was extended before
                continue
            item = self.items[n][1]
            size, run = stretch(item, at, doc, start)
            ends[line] = start + run - SEED
            if size > best.get(n, 0):
                best[n] = size
        return [(self.items[n][0], size) for n, size in best.items() if size >= WINDOW]


def reach(a: list[str], i: int, b: list[str], j: int, step: int) -> list[int]:
    """Words of ``a`` from ``i`` on (in direction ``step``) that ``b`` from ``j`` on repeats with 0, 1, ... ``EDITS`` edits.

    A word of ``a`` that is replaced or dropped counts as covered.
    """
    na = len(a) - i if step > 0 else i + 1
    nb = len(b) - j if step > 0 else j + 1

    def slide(x: int, y: int) -> tuple[int, int]:
        while x < na and y < nb and a[i + step * x] == b[j + step * y]:
            x += 1
            y += 1
        return x, y

    front = {slide(0, 0)}
    out = [max(x for x, _ in front)]
    for _ in range(EDITS):
        nxt = set()
        for x, y in front:
            if x < na and y < nb:
                nxt.add(slide(x + 1, y + 1))
            if x < na:
                nxt.add(slide(x + 1, y))
            if y < nb:
                nxt.add(slide(x, y + 1))
        front = nxt or front
        out.append(max(out[-1], *(x for x, _ in front)))
    return out


def stretch(item: list[str], at: int, doc: list[str], start: int) -> tuple[int, int]:
    """The longest stretch of item words around a seed with at most ``EDITS`` edits, and the length of the exact run."""
    right = reach(item, at + SEED, doc, start + SEED, 1)
    left = reach(item, at - 1, doc, start - 1, -1)
    return SEED + max(left[k] + right[EDITS - k] for k in range(EDITS + 1)), SEED + right[0]


_BUILT: dict[int, Patterns] = {}


def _patterns(number: int, items: list[tuple[int | None, str | None]]) -> Patterns:
    """A block's tables, kept for the worker's next tasks; only one block's at a time."""
    if number not in _BUILT:
        _BUILT.clear()
        _BUILT[number] = Patterns(items)
    return _BUILT[number]


def leaked(documents: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents with the items they contain: ``doc_id, item_id, repeated_words``, one row per pair."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = documents.sparkSession
    schema = "doc_id long, item_id long, repeated_words int"
    out = spark.createDataFrame([], schema)
    block: list[tuple[int | None, str | None]] = []

    def search(part: list[tuple[int | None, str | None]]) -> DataFrame:
        held = spark.sparkContext.broadcast(part)
        number = held._jbroadcast.id()

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            patterns = _patterns(number, held.value)
            for b in batches:
                rows = [(d, i, n) for d, t in zip(b["doc_id"].tolist(), b["text"].tolist()) for i, n in patterns.contained(t)]
                yield pd.DataFrame({"doc_id": pd.array([None if r[0] is None or r[0] != r[0] else int(r[0]) for r in rows], dtype="Int64"), "item_id": pd.array([r[1] for r in rows], dtype="Int64"), "repeated_words": pd.array([r[2] for r in rows], dtype="Int32")})

        return docs.mapInPandas(run, schema)

    chars = 0
    for row in items.select(F.col(item_id).cast("long"), F.col(item_text)).toLocalIterator():
        if block and (len(block) >= ITEM_BLOCK or chars + len(row[1] or "") > ITEM_CHARS):
            out, block, chars = out.unionByName(search(block)), [], 0
        block.append((row[0], row[1]))
        chars += len(row[1] or "")
    if block:
        out = out.unionByName(search(block))
    return out.groupBy("doc_id", "item_id").agg(F.max("repeated_words").alias("repeated_words"))
