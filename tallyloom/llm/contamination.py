"""Benchmark decontamination with suffix arrays of the training text.

Each shard of documents (a batch of a task, a few MB) gets a suffix array over its words. Every suffix of every test item is
looked up in it by binary search; the suffixes that share its first words stand side by side, and each is a verbatim match
with its location. Words are compared by 64-bit hash in the search, and matched words byte by byte after it. Windows of the
same words, as of a prompt that many items begin with, are one test suffix with a list of items, so that a place in a
document meets at most one window of each length.

Test items are a stated query set: they are sent to the tasks in blocks of bounded size, and the documents go by once for
all blocks, without a shuffle. A suffix that starts with no two words of any test item can't match and isn't sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.textbytes import PrefixHash, byte_hashes, by_size, mix, text_bytes

BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
ADDED = ("n_words", "hit_spans", "items", "longest_match")
# A-Z lower-cased; letters, digits and all bytes of non-ASCII characters make words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


@dataclass
class Words:
    """The words of some texts: ``data`` lower-cased bytes, ``start``/``end`` of each, its ``hash``, and the texts' ``bounds`` in words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = WORD_BYTE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True  # a word never goes on into the next text
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
        hashed = mix(byte_hashes(data).run(start, end)) if len(start) else np.zeros(0, np.uint64)
        return cls(data, start, end, hashed, np.searchsorted(start, offsets))

    def text_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, word, side="right") - 1


class TestItems:
    """A block of test items: their words, and their different windows, each with a start, a length and the items that have it."""

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int) -> None:
        self.ids, self.words, self.window = ids, Words.of(texts), window
        self.sizes = np.diff(self.words.bounds)
        counts = np.where(self.sizes >= window, self.sizes - window + 1, (self.sizes > 0).astype(np.int64))
        item = np.repeat(np.arange(len(counts)), counts)
        start = self.words.bounds[item] + np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
        length = np.minimum(self.sizes[item], window)
        fold = self.folded(start, length)
        first = np.unique(fold, return_index=True)[1]
        self.at, self.length = start[first], length[first]
        self.item_lists, self.list_of = item_lists(fold, item)
        # Suffixes whose first ``lead`` words are none of these hold no window.
        self.lead = int(min(self.length.min(initial=window), 2))
        self.leads = np.unique(run_hashes(self.words.hash, self.at, self.lead)) if len(self.at) else np.zeros(0, np.uint64)
        self.deepest = int(self.length.max(initial=0))

    def folded(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A number for each window, from 0, that windows of the same words share: equal hashes, then equal bytes."""
        hashes = PrefixHash(self.words.hash).run(start, start + length) if len(start) else np.zeros(0, np.uint64)
        order = np.lexsort((hashes, length))
        fold, used = np.full(len(start), -1), 0
        while len(order):  # again only for different words of one hash
            own_hash, own_length = hashes[order], length[order]
            new = np.append(True, (own_hash[1:] != own_hash[:-1]) | (own_length[1:] != own_length[:-1]))
            group = np.cumsum(new) - 1
            head = order[np.flatnonzero(new)][group]
            same = np.ones(len(order), bool)
            for d in range(int(own_length.max())):
                some = np.flatnonzero(same & (d < own_length))
                same[some] = same_words(self.words, start[order[some]] + d, self.words, start[head[some]] + d)
            fold[order[same]] = used + group[same]
            used += int(group[-1]) + 1
            order = order[~same]
        return fold

    @cached_property
    def long_suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """The starts of full windows in the order of the word hashes from there to the end of the item, and these ends.

        Suffixes that agree in 2^n words are ordered by the order of what follows these, so log(words) sorts do.
        """
        ends = np.repeat(self.words.bounds[1:], self.sizes)
        rank = np.unique(self.words.hash, return_inverse=True)[1].astype(np.int64)
        here, step = np.arange(len(rank)), 1
        while step < self.sizes.max(initial=0):
            after = np.where(here + step < ends, rank[np.minimum(here + step, len(rank) - 1)] + 1, 0)
            rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1].astype(np.int64)
            step *= 2
        long = np.flatnonzero(here + self.window <= ends)
        rank, first = np.unique(rank[long], return_index=True)
        return long[first], ends[long[first]]


def item_lists(fold: np.ndarray, item: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
    """The different lists of items that windows have, and the number of its list for each window."""
    pairs = np.unique(np.stack([fold, item]), axis=1)
    bounds = np.flatnonzero(np.append(True, pairs[0, 1:] != pairs[0, :-1])) if pairs.shape[1] else np.zeros(0, np.int64)
    number: dict[bytes, int] = {}
    lists: list[list[int]] = []
    list_of = np.zeros(len(bounds), np.int64)
    for i, own in enumerate(np.split(pairs[1], bounds[1:]) if len(bounds) else []):
        list_of[i] = number.setdefault(own.tobytes(), len(number))
        if list_of[i] == len(lists):
            lists.append(own.tolist())
    return lists, list_of


def run_hashes(words: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each start."""
    return mix(PrefixHash(words).run(start, start + n))


def suffix_array(words: Words, leads: np.ndarray, lead: int, depth: int) -> np.ndarray:
    """Positions of the suffixes that start with one of ``leads``, in the order of their word hashes up to ``depth`` words.

    Groups of suffixes that agree so far are sorted by their next word, again and again, until each stands alone or has
    been compared to the full depth. A suffix ends with its document, and then comes first.
    """
    ends = np.repeat(words.bounds[1:], np.diff(words.bounds))
    at = np.arange(max(len(words.hash) - lead + 1, 0))
    at = at[at + lead <= ends[: len(at)]]
    if not len(at) or not len(leads):
        return np.zeros(0, np.int64)
    found = run_hashes(words.hash, at, lead)
    place = np.minimum(np.searchsorted(leads, found), len(leads) - 1)
    at = at[leads[place] == found]
    padded = np.append(words.hash, np.uint64(0))
    group = np.zeros(len(at), np.int64)
    open_from, todo = 0, np.arange(len(at))
    for d in range(depth):
        if not len(todo):
            break
        own = at[todo]
        word = np.where(own + d < ends[own], padded[np.minimum(own + d, len(words.hash))], np.uint64(0))
        order = np.lexsort((word, group[todo]))
        own, word, old = own[order], word[order], group[todo][order]
        at[todo] = own  # places of one group are contiguous, so they are refilled in order
        new = np.ones(len(own), bool)
        new[1:] = (word[1:] != word[:-1]) | (old[1:] != old[:-1])
        group[todo] = open_from + np.cumsum(new)
        open_from += len(own)
        alone = new & np.append(new[1:], True)
        todo = todo[~alone]
    return at


def lookup(array: np.ndarray, words: Words, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """For every test suffix (window start) the range of the suffix array that begins with its window."""
    ends = np.append(np.repeat(words.bounds[1:], np.diff(words.bounds)), 0)
    padded = np.append(words.hash, np.uint64(0))
    tests = np.append(items.words.hash, np.uint64(0))

    def below(place: np.ndarray, which: np.ndarray, after: bool) -> np.ndarray:
        """Whether the suffix at each place sorts before the window (or, with ``after``, begins with it as well)."""
        own, test, length = array[place], items.at[which], items.length[which]
        result = np.full(len(place), after)
        open_ = np.arange(len(place))
        for d in range(items.deepest):
            open_ = open_[d < length[open_]]
            if not len(open_):
                break
            p = own[open_] + d
            word = np.where(p < ends[own[open_]], padded[np.minimum(p, len(words.hash))], np.uint64(0))
            wanted = tests[test[open_] + d]
            result[open_[word != wanted]] = (word < wanted)[word != wanted]
            open_ = open_[word == wanted]
        return result

    def bound(after: bool) -> np.ndarray:
        low, high = np.zeros(len(items.at), np.int64), np.full(len(items.at), len(array), np.int64)
        while True:
            which = np.flatnonzero(low < high)
            if not len(which):
                return low
            middle = (low[which] + high[which]) // 2
            less = below(middle, which, after)
            low[which] = np.where(less, middle + 1, low[which])
            high[which] = np.where(less, high[which], middle)

    return bound(False), bound(True)


def same_words(words: Words, at: np.ndarray, tests: Words, test_at: np.ndarray) -> np.ndarray:
    """Whether words are equal byte for byte."""
    size = words.end[at] - words.start[at]
    equal = size == tests.end[test_at] - tests.start[test_at]
    todo, j = np.flatnonzero(equal), 0
    while len(todo):
        ok = words.data[words.start[at[todo]] + j] == tests.data[tests.start[test_at[todo]] + j]
        equal[todo[~ok]] = False
        j += 1
        todo = todo[ok & (size[todo] > j)]
    return equal


def matches(words: Words, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a document position and the number of the test window that occurs there, every one of them."""
    array = suffix_array(words, items.leads, items.lead, items.deepest)
    if not len(array):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = lookup(array, words, items)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    place = np.repeat(low, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    at = array[place]
    sure = np.ones(len(at), bool)
    for d in range(items.deepest):
        some = np.flatnonzero(sure & (d < items.length[which]))
        sure[some] = same_words(words, at[some] + d, items.words, items.at[which[some]] + d)
    return at[sure], which[sure]


def common(own: PrefixHash, at: np.ndarray, ends: np.ndarray, other: PrefixHash, test_at: np.ndarray, test_ends: np.ndarray) -> np.ndarray:
    """How many words each two runs have in common from their starts, by binary search on their prefix hashes."""
    low, high = np.zeros(len(at), np.int64), np.minimum(ends - at, test_ends - test_at)
    while True:
        todo = np.flatnonzero(low < high)
        if not len(todo):
            return low
        n = (low[todo] + high[todo] + 1) // 2
        a, b = at[todo], test_at[todo]
        same = own.run(a, a + n) == other.run(b, b + n)
        low[todo] = np.where(same, n, low[todo])
        high[todo] = np.where(same, high[todo], n - 1)


def longest(words: Words, at: np.ndarray, which: np.ndarray, items: TestItems) -> np.ndarray:
    """The words of the longest verbatim match with an item that starts with each match of a window, by hash beyond the window.

    It is with one of the two suffixes of items between which that of the document would be sorted.
    """
    result = items.length[which].copy()
    full = np.flatnonzero(result == items.window)
    if not len(full):
        return result
    suffixes, suffix_ends = items.long_suffixes
    own = at[full]
    ends = words.bounds[words.text_of(own) + 1]
    padded, tests = np.append(words.hash, np.uint64(0)), np.append(items.words.hash, np.uint64(0))

    hashes = PrefixHash(words.hash), PrefixHash(items.words.hash)

    def against(i: np.ndarray, place: np.ndarray) -> np.ndarray:
        return common(hashes[0], own[i], ends[i], hashes[1], suffixes[place], suffix_ends[place])

    low, high = np.zeros(len(own), np.int64), np.full(len(own), len(suffixes), np.int64)
    while True:
        todo = np.flatnonzero(low < high)
        if not len(todo):
            break
        middle = (low[todo] + high[todo]) // 2
        n = against(todo, middle)
        a, b = own[todo] + n, suffixes[middle] + n
        done = b >= suffix_ends[middle]  # the item's suffix begins the document's, so it sorts before it
        less = done | (a < ends[todo]) & (tests[np.minimum(b, len(tests) - 1)] < padded[a])
        low[todo] = np.where(less, middle + 1, low[todo])
        high[todo] = np.where(less, high[todo], middle)
    everything = np.arange(len(own))
    best = np.maximum(against(everything, np.maximum(low - 1, 0)), against(everything, np.minimum(low, len(suffixes) - 1)))
    result[full] = np.maximum(result[full], best)
    return result


def test_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list]:
    """The items' ids and texts, in blocks of about ``block_bytes``; each block is collected on its own. An id may be null."""
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 0
    blocks = -(-size // block_bytes)
    for i in range(blocks):
        yield rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i).orderBy("id", "text").collect()


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans``, ``items``, ``longest_match``.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. ``hit_spans`` are
    the [from, to) word spans of the document that any occurrence of a window covers, merged; ``items`` the ids, as sorted
    text, of the items whose windows occur; ``longest_match`` the words of the longest verbatim match (0 for none). A null
    or wordless text has no words and no hits. Items that share an id count as one; those without id count for all but
    ``items``. No items at all match nothing. Repeated documents are judged one by one; columns of the added names are replaced.
    """
    names = [c for c in docs.columns if c not in ADDED]
    span = T.ArrayType(T.LongType())
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(span)),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest_match", T.LongType()),
    ]
    schema = T.StructType(docs.select(names).schema.fields + fields)
    arrow = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string()), pa.int64()]

    def pass_over(frame: DataFrame, block: list) -> DataFrame:
        shared = frame.sparkSession.sparkContext.broadcast([tuple(r) for r in block])  # at most about block_bytes

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test = TestItems([r[0] for r in shared.value], pa.array([r[1] for r in shared.value], pa.string()), window)
            for batch in by_size(batches, text, SHARD_BYTES):
                words = Words.of(batch.column(batch.schema.get_field_index(text)))
                n = batch.num_rows
                at, which = matches(words, test)
                cover = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + test.length[which], -1)
                hit = np.cumsum(cover[:-1]) > 0
                spans, ids, longest_of = [[] for _ in range(n)], [set() for _ in range(n)], np.zeros(n, np.int64)
                if batch.schema.names[-1] == "longest_match":  # what earlier blocks have found
                    columns = [batch.column(i).to_pylist() for i in range(-3, 0)]
                    for i in range(n):
                        for a, b in columns[0][i]:
                            hit[words.bounds[i] + a : words.bounds[i] + b] = True
                        ids[i].update(columns[1][i])
                        longest_of[i] = columns[2][i]
                for d in np.unique(words.text_of(np.flatnonzero(hit))):
                    own = hit[words.bounds[d] : words.bounds[d + 1]]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                    spans[d] = edge.reshape(-1, 2).tolist()
                doc = words.text_of(at)
                for d, i in np.unique(np.stack([doc, test.list_of[which]]), axis=1).T:
                    ids[d].update(test.ids[x] for x in test.item_lists[i] if test.ids[x] is not None)
                np.maximum.at(longest_of, doc, longest(words, at, which, test))
                values = [np.diff(words.bounds), spans, [sorted(x) for x in ids], longest_of]
                kept = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name not in ADDED]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(v, t) for v, t in zip(values, arrow, strict=True))], [*names, *ADDED]
                )

        return frame.mapInArrow(search, schema)

    found = docs.select(names)
    some = False
    for some, block in enumerate(test_blocks(items, item_id, item_text, block_bytes), 1):
        found = pass_over(found, block)
        if some % 8 == 0:
            found = found.checkpoint()
    return found if some else pass_over(found, [])


def n_hit(hit_spans: Column) -> Column:
    """The number of words in the spans."""
    return F.aggregate(hit_spans, F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no test window occurs in, with all their columns; options as for ``find_contamination``."""
    clash = {c: f"__kept_{c}" for c in docs.columns if c in ADDED}
    found = find_contamination(docs.withColumnsRenamed(clash), items, **options)
    return found.where(F.size("hit_spans") == 0).select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
