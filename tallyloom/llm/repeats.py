"""Suffix-array dedup: long strings that an earlier document holds as well are cut out.

A string of ``length`` bytes is held against all others by sorting suffixes. They are sorted by their bytes, a word at a time,
of which only those go on that still agree with another one: that costs the same for each suffix, however many agree. Neighbours
are compared by prefix polynomial hashes, a binary search over the length, and byte by byte before they count as equal.

To sort them together, suffixes have to meet in one place. Every string has an anchor, its ``k``-byte run of least hash (the
leftmost of equal ones). Equal strings have equal anchors at equal places, so suffixes are dealt to buckets by their
anchor, and strings in a row that share one travel as a single stretch of at most ``2 * length`` bytes:

1. Documents are dealt to packs of a few MB. A pack sends each bucket the hashes of its stretches and their document ids.
2. A bucket finds, for each stretch, whether an earlier document holds the same stretch, and which anchors come with
   different ones. Of equal stretches only the first document's goes on.
3. Packs send the bytes of those, and the bucket sorts their suffixes as described.
4. Packs put the answers together and cut their documents.

Stretches are counted as equal by 80 bits of hash and their bucket in step 2, by their bytes in step 3. A string that all
documents hold costs one entry for each document in step 2, a few bytes, and one stretch in step 3.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.textbytes import CHUNK, PrefixHash, byte_hashes, mix, text_bytes

U64 = np.uint64
ENTRY_BYTES = 0.9  # of hashes for each byte of text, about
SORTED_AT_ONCE = 1 << 20  # suffixes; one place in the strings of one anchor may have more
ANSWER, SORTED = "answer", "sorted"


@dataclass
class Stretches:
    """The stretches of a pack, and its entries: the distinct ones of each document, in an order that only contents decide.

    ``first``, ``last``: starts of the first and last string of each stretch, ``anchor``: where its anchor starts, ``entry``: the
    number of its entry. Of each entry ``bucket``, ``doc``, ``h``, ``s`` and ``sample``, one of its stretches.
    """

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    entry: np.ndarray
    bucket: np.ndarray
    doc: np.ndarray
    h: np.ndarray
    s: np.ndarray
    sample: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, ids: np.ndarray, known: np.ndarray, length: int, k: int, buckets: int) -> Stretches:
        data, offsets = text_bytes(texts)
        n = len(data)
        none = np.zeros(0, np.int64)
        if n < length:
            return cls(data, offsets, *[none] * 4, none, none, none.astype(np.uint32), none.astype(U64), none)
        hashes = byte_hashes(data)
        anchor, changes = anchors(hashes, n, length, k)
        # A string lies inside one document, whose id is known.
        row = np.flatnonzero(known & (np.diff(offsets) >= length))
        begin, stop = offsets[row], offsets[row + 1] - length + 1
        first = np.sort(np.concatenate([begin, changes]))
        first = first[np.diff(first, prepend=-1) > 0]
        of = np.searchsorted(begin, first, side="right") - 1
        inside = (of >= 0) & (first < stop[of]) if len(row) else np.zeros(len(first), bool)
        first, of = first[inside], of[inside]
        last = np.minimum(np.append(first[1:], n), stop[of]) - 1
        row, anchor = row[of], anchor[first].astype(np.int64)
        h = mix(hashes.run(anchor, anchor + k))
        full = mix(h)  # anew, as anchors have small hashes, which would crowd into the first buckets
        end = last + length
        s = mix(hashes.run(first, end) + (end - first).astype(U64)) & U64((1 << 48) - 1)
        bucket = (full >> U64(32)) * U64(buckets) >> U64(32)
        h32 = full & U64(0xFFFFFFFF)
        rank = np.unique(ids, return_inverse=True)[1].astype(U64)[row]
        bits = int(rank.max(initial=U64(0))).bit_length()
        key = bucket << U64(bits) | rank
        rest = (h32, s)
        if (buckets - 1).bit_length() + bits <= 32:
            key, rest = key << U64(32) | h32, (s,)
        order = sorted_order(key, *rest)
        new = np.ones(len(order), bool)
        new[1:] = False
        for values in (key, *rest):
            some = values[order]
            new[1:] |= some[1:] != some[:-1]
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        sample = order[new]
        doc = ids[row[sample]]
        return cls(data, offsets, first, last, anchor, entry, bucket[sample].astype(np.int64), doc, h32[sample].astype(np.uint32), s[sample], sample)

    def parts(self) -> list[tuple[int, int, int]]:
        """Each bucket with the range of its entries."""
        starts = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        ends = np.append(starts, len(self.bucket))[1:]
        return [(int(self.bucket[a]), int(a), int(b)) for a, b in zip(starts, ends, strict=True)]


def anchors(hashes: PrefixHash, n: int, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each string of ``length`` of the ``n`` bytes, where its run of least hash starts, the leftmost of equal ones; and the
    strings that start with another one than the string before."""
    window = length - k + 1
    bits = U64((CHUNK + window).bit_length())
    place = (U64(1) << bits) - U64(1)
    found = np.empty(n - length + 1, np.int64 if n >> 31 else np.int32)
    changes = []
    for a in range(0, len(found), CHUNK):
        b = min(a + CHUNK, len(found))
        e = b + window - 1
        least = mix((hashes.sums[a + k : e + k] - hashes.sums[a:e]) * hashes.down[a:e])
        least &= ~place
        least |= np.arange(e - a, dtype=U64)
        width = 1
        while width * 2 <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if window > width:
            least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        found[a:b] = least & place
        found[a:b] += a
        before = max(a - 1, 0)
        changes.append(np.flatnonzero(found[before + 1 : b] != found[before : b - 1]) + before + 1)
    return found, np.concatenate(changes)


def sorted_order(key: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    """The order by ``key`` and, among equal ones, by ``rest``: only those go through the slower sort by several columns."""
    order = np.argsort(key)
    found = key[order]
    tied = np.zeros(len(order), bool)
    tied[1:] = found[1:] == found[:-1]
    tied[:-1] |= tied[1:]
    place = np.flatnonzero(tied)
    some = order[place]
    if rest:
        order[place] = some[np.lexsort([*(x[some] for x in reversed(rest)), found[place]])]
    return order


def squeeze(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(numbers).tobytes(), 1)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def text_codec() -> pa.Codec:
    """For bytes of texts: a third of the time that zlib takes, and no larger."""
    return pa.Codec("zstd", compression_level=1)


def deltas(docs: np.ndarray) -> bytes:
    return squeeze(np.diff(docs, prepend=0).astype("<i8"))


def undeltas(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, "<i8"))


def low_bytes(numbers: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def from_low_bytes(data: bytes, n: int) -> np.ndarray:
    wide = np.zeros((len(data) // n, 8), np.uint8)
    wide[:, :n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return wide.view("<u8").reshape(-1)


def classify(h: np.ndarray, s: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry of a bucket: whether an earlier document has the same stretch, and whether its bytes are asked for.

    They are asked for from the first document of each stretch whose anchor comes with other stretches and documents.
    """
    order = sorted_order(h.astype(U64) << U64(32) | s >> U64(16), s, doc)
    h, s, doc = h[order], s[order], doc[order]
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new_s = new_h.copy()
    new_s[1:] |= s[1:] != s[:-1]
    of_s, of_h = np.cumsum(new_s) - 1, np.cumsum(new_h) - 1
    earliest = doc[new_s][of_s]
    if len(h):
        starts = np.flatnonzero(new_h)
        mixed = np.add.reduceat(new_s.astype(np.int64), starts) > 1
        mixed &= np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    else:
        mixed = np.zeros(0, bool)
    repeated, asked = np.empty(len(h), bool), np.empty(len(h), bool)
    repeated[order] = doc > earliest
    asked[order] = mixed[of_h] & (doc == earliest)
    return repeated, asked


class SuffixOrder:
    """Suffixes of ``data`` up to ``length`` bytes, sorted by their bytes and compared by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int) -> None:
        self.data, self.length, self.hashes = data, length, byte_hashes(data)
        padded = np.concatenate([data, np.zeros(7, np.uint8)])
        self.words = np.zeros(len(data), U64)  # the eight bytes from each position on
        for j in range(8):
            self.words <<= U64(8)
            self.words |= padded[j : j + len(data)]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes two suffixes have in common, by binary search over equal prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        for _ in range(self.length.bit_length()):
            middle = (low + high + 1) // 2
            same = self.hashes.run(a, a + middle) == self.hashes.run(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def sort(self, suffix: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of ``suffix`` inside each group; groups are contiguous. Those that still agree with another one are
        sorted by their next bytes, as many as fit into a word beside the number of the class they agree in."""
        order = np.arange(len(suffix))
        new = np.ones(len(suffix) + 1, bool)  # where a class starts, and after the last one
        new[1:-1] = group[1:] != group[:-1]
        place, done = order.copy(), 0
        while done < self.length:
            place = place[~(new[place] & new[place + 1])]
            if not len(place):
                break
            number = np.cumsum(new[place]).astype(U64)
            n = min(8 - (int(number[-1]).bit_length() + 7) // 8, self.length - done)
            some = order[place]
            key = number << U64(8 * n) | self.words[suffix[some] + done] >> U64(64 - 8 * n)
            by_key = np.argsort(key)
            order[place] = some[by_key]
            key = key[by_key]
            new[place[1:]] |= key[1:] != key[:-1]
            done += n
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two strings of full length are equal, byte by byte."""
        same = np.ones(len(a), bool)
        for j in range(0, self.length, 8):
            rest = U64(8 * max(0, j + 8 - self.length))
            same &= self.words[a + j] >> rest == self.words[b + j] >> rest
        return same


def repeated_strings(
    data: np.ndarray, at: np.ndarray, size: np.ndarray, lead: np.ndarray, h: np.ndarray, doc: np.ndarray, length: int
) -> np.ndarray:
    """A bit for each string of each stretch (its first string is the lowest): whether an earlier document has it.

    ``at``, ``size``: of each stretch in ``data``; ``lead``: bytes before its anchor; ``h``: its anchor's hash.
    """
    bits = np.zeros(len(at), U64)
    if not len(at):
        return bits
    # Strings are held against those of the same anchor at the same place in them: some anchors at a time, or some places of one.
    by_anchor = np.argsort(h, kind="stable")
    most = int(lead.max()) + 1  # places of the anchor in a string
    count = size - length + 1
    starts = np.flatnonzero(np.diff(h[by_anchor].astype(np.int64), prepend=-1))
    total = np.cumsum(np.add.reduceat(count[by_anchor], starts))
    ends = np.append(starts[1:], len(at))
    i = 0
    while i < len(starts):
        before = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, before + SORTED_AT_ONCE, side="right")))
        some = by_anchor[starts[i] : ends[j - 1]]
        parts = min(most, -(-int(total[j - 1] - before) // SORTED_AT_ONCE))
        for part in range(parts):
            low, high = most * part // parts, most * (part + 1) // parts
            first = np.maximum(lead[some] - high + 1, 0)
            n = np.minimum(lead[some] - low + 1, count[some]) - first
            own, first, n = some[n > 0], first[n > 0], n[n > 0]
            which, number = np.repeat(own, n), spread(first, n)
            suffixes = SuffixOrder(data[spread(at[own] + first, n + length - 1)], length)
            start = number + np.repeat(np.cumsum(n + length - 1) - (n + length - 1) - first, n)
            gone = already_held(suffixes, start, lead[which] - number, h[which], doc[which])
            np.bitwise_or.at(bits, which[gone], U64(1) << number[gone].astype(U64))
        i = j
    return bits


def already_held(suffixes: SuffixOrder, start: np.ndarray, offset: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each string, whether an earlier document has it at the same ``offset`` from the same anchor."""
    order = sorted_order(h.astype(U64) << U64(32) | offset.astype(U64))
    h, offset, start = h[order], offset[order], start[order]
    change = np.ones(len(order), bool)
    change[1:] = (h[1:] != h[:-1]) | (offset[1:] != offset[:-1])
    group = np.cumsum(change) - 1
    sort = suffixes.sort(start, group)
    order, start = order[sort], start[sort]
    new = np.ones(len(sort), bool)
    beside = np.flatnonzero(group[1:] == group[:-1]) + 1
    agree = beside[suffixes.common(start[beside - 1], start[beside]) == suffixes.length]
    new[agree[suffixes.equal(start[agree - 1], start[agree])]] = False
    classes = np.cumsum(new) - 1
    earliest = np.full(classes.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, classes, doc[order])
    gone = np.empty(len(order), bool)
    gone[order] = doc[order] > earliest[classes]
    return gone


def without(data: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Of each text the runs of bytes that are ``gone``, as [from, to) in it, and its other bytes."""
    begin, end = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1
    starts, stops = gone.copy(), gone.copy()
    starts[1:] &= ~gone[:-1]
    starts[begin] = gone[begin]
    stops[:-1] &= ~gone[1:]
    stops[end] = gone[end]
    edges = np.stack([np.flatnonzero(starts), np.flatnonzero(stops) + 1], 1)
    bounds = np.searchsorted(edges[:, 0], offsets)
    edges -= np.repeat(offsets[:-1], np.diff(bounds))[:, None]
    pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, edges.size + 2, 2), pa.int32()), pa.array(edges.ravel(), pa.int64()))
    left = np.append(0, np.cumsum(~gone))[offsets]
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(left) - 1, [None, pa.py_buffer(left), pa.py_buffer(data[~gone])])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pairs), kept.cast(pa.binary())


def cut_repeats(
    docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", pack_bytes: int | None = None, bucket_bytes: int | None = None
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` and ``kept`` for ``text``: its UTF-8 bytes without those that repeat an earlier document's.

    A byte is cut if a string of ``length`` bytes that covers it also starts in a document with a smaller ``doc_id``. Strings
    overlap, never cross documents, and are judged on the input. ``spans`` are the maximal cut runs as [from, to) byte offsets,
    ``kept`` the other bytes in a row, as binary since a cut may fall inside a character. A null text is empty; texts shorter
    than ``length`` stay whole. Rows that share an id don't cut each other; a row without an id is kept whole and cuts none.
    Columns called like the added ones are replaced. ``pack_bytes`` and ``bucket_bytes`` bound what one task holds at a time.
    """
    k = max(length // 2, length - 63)
    names = [c for c in docs.columns if c not in (text, "n_bytes", "spans", "kept")]
    total = docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
    # Both grow with the square root of the input, so that what a pack sends to a bucket doesn't become ever smaller.
    bucket_bytes = bucket_bytes or int(min(256 << 20, max(4 << 20, (4 << 20) * math.sqrt(total / (1 << 30)))))
    pack_bytes = pack_bytes or bucket_bytes // 4
    buckets = max(1, math.ceil(ENTRY_BYTES * total / bucket_bytes))
    packs = max(1, math.ceil(total / pack_bytes))
    dealt = docs.select(
        *names,
        F.col(doc_id).cast("long").alias("__doc"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("__bytes"),
        F.pmod(F.xxhash64(doc_id), F.lit(packs)).alias("__pack"),
    )

    def stretches(pack: pa.Table) -> Stretches:
        ids = pack.column("__doc").combine_chunks()
        known = ~np.asarray(ids.is_null())
        return Stretches.of(pack.column("__bytes"), np.asarray(ids.fill_null(0)), known, length, k, buckets)

    hashed_schema = "bucket long, pack long, h binary, s binary, docs binary"

    def send_hashes(pack: pa.Table) -> pa.Table:
        found = stretches(pack)
        rows = [
            (b, pack.column("__pack")[0].as_py(), found.h[i:j].astype("<u4").tobytes(), low_bytes(found.s[i:j], 6), deltas(found.doc[i:j]))
            for b, i, j in found.parts()
        ]
        return table(rows, HASHED_ARROW)

    answer_schema = "pack long, bucket long, kind string, data binary"

    def answer(rows: pa.Table) -> pa.Table:
        column = {c: rows.column(c).to_pylist() for c in rows.column_names}
        h = np.frombuffer(b"".join(column["h"]), "<u4")
        s = from_low_bytes(b"".join(column["s"]), 6)
        docs_ = [undeltas(d) for d in column["docs"]]
        repeated, asked = classify(h, s, np.concatenate(docs_))
        out, at = [], 0
        for pack, bucket, d in zip(column["pack"], column["bucket"], docs_, strict=True):
            flags = np.concatenate([repeated[at : at + len(d)], asked[at : at + len(d)]])
            out.append((pack, bucket, ANSWER, zlib.compress(np.packbits(flags).tobytes(), 1)))
            at += len(d)
        return table(out, ANSWER_ARROW)

    def answered(found: Stretches, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """Of each entry whether it is repeated and whether it was asked for, and what came of the sort, by bucket."""
        repeated, asked = np.zeros(len(found.doc), bool), np.zeros(len(found.doc), bool)
        ranges = {b: (i, j) for b, i, j in found.parts()}
        sorted_: dict[int, np.ndarray] = {}
        for bucket, kind, data in zip(*(answers.column(c).to_pylist() for c in ("bucket", "kind", "data")), strict=True):
            if kind == SORTED:
                sorted_[bucket] = unsqueeze(data, "<u8")
                continue
            i, j = ranges[bucket]
            flags = np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=2 * (j - i)).astype(bool)
            repeated[i:j], asked[i:j] = flags[: j - i], flags[j - i :]
        return repeated, asked, sorted_

    bytes_schema = "bucket long, pack long, sizes binary, leads binary, h binary, docs binary, bytes binary"

    def send_bytes(pack: pa.Table, answers: pa.Table) -> pa.Table:
        if not pack.num_rows:
            return table([], BYTES_ARROW)
        found = stretches(pack)
        _, asked, _ = answered(found, answers)
        rows = []
        for bucket, i, j in found.parts():
            some = np.flatnonzero(asked[i:j]) + i
            if len(some):
                run = found.sample[some]
                a, end = found.first[run], found.last[run] + length
                rows.append(
                    (
                        bucket,
                        pack.column("__pack")[0].as_py(),
                        squeeze((end - a).astype("<u2")),
                        squeeze((found.anchor[run] - a).astype("<u2")),
                        found.h[some].astype("<u4").tobytes(),
                        deltas(found.doc[some]),
                        text_codec().compress(found.data[spread(a, end - a)].tobytes(), asbytes=True),
                    )
                )
        return table(rows, BYTES_ARROW)

    def sort_suffixes(rows: pa.Table) -> pa.Table:
        column = {c: rows.column(c).to_pylist() for c in rows.column_names}
        sizes = [unsqueeze(x, "<u2").astype(np.int64) for x in column["sizes"]]
        size, codec = np.concatenate(sizes), text_codec()
        bits = repeated_strings(
            np.frombuffer(b"".join(codec.decompress(x, int(n.sum()), asbytes=True) for x, n in zip(column["bytes"], sizes, strict=True)), np.uint8),
            np.cumsum(size) - size,
            size,
            np.concatenate([unsqueeze(x, "<u2") for x in column["leads"]]).astype(np.int64),
            np.frombuffer(b"".join(column["h"]), "<u4"),
            np.concatenate([undeltas(x) for x in column["docs"]]),
            length,
        )
        ends = np.cumsum([len(x) for x in sizes])
        return table(
            [
                (pack, bucket, SORTED, squeeze(bits[end - len(x) : end].astype("<u8")))
                for pack, bucket, x, end in zip(column["pack"], column["bucket"], sizes, ends, strict=True)
            ],
            ANSWER_ARROW,
        )

    added = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("kept", T.BinaryType()),
    ]
    schema = T.StructType(docs.select(names).schema.fields + added)

    def cut(pack: pa.Table, answers: pa.Table) -> pa.Table:
        found = stretches(pack)
        repeated, asked, sorted_ = answered(found, answers)
        bits = np.zeros(len(found.doc), U64)
        for bucket, i, j in found.parts():
            if bucket in sorted_:
                bits[np.flatnonzero(asked[i:j]) + i] = sorted_[bucket]
        n = len(found.data)
        # No two stretches start or end together, so that no place is added to twice at once.
        cover = np.zeros(n + 1, np.int32)
        whole = repeated[found.entry]
        cover[found.first[whole]] += 1
        cover[found.last[whole] + length] -= 1
        rest = np.flatnonzero(~whole & (bits[found.entry] > 0))
        own = bits[found.entry[rest]]
        for j in range(length - k + 1):
            at = found.first[rest[(own >> U64(j)) & U64(1) > 0]] + j
            cover[at] += 1
            cover[at + length] -= 1
        spans, kept = without(found.data, found.offsets, np.cumsum(cover[:-1], dtype=np.int32) > 0)
        columns = [pack.column(c) for c in names] + [pa.array(np.diff(found.offsets)), spans, kept]
        return pa.Table.from_arrays(columns, [*names, "n_bytes", "spans", "kept"])

    by_pack = dealt.groupBy("__pack")
    # Dealt to packs here, so that both uses read one exchange and no bucket is answered twice.
    answers = by_pack.applyInArrow(send_hashes, hashed_schema).groupBy("bucket").applyInArrow(answer, answer_schema).repartition("pack")
    strings = by_pack.cogroup(answers.groupBy("pack")).applyInArrow(send_bytes, bytes_schema)
    sorted_ = strings.groupBy("bucket").applyInArrow(sort_suffixes, answer_schema)
    return by_pack.cogroup(answers.union(sorted_).groupBy("pack")).applyInArrow(cut, schema)


HASHED_ARROW = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("h", pa.binary()), ("s", pa.binary()), ("docs", pa.binary())])
ANSWER_ARROW = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("kind", pa.string()), ("data", pa.binary())])
BYTES_ARROW = pa.schema(
    [("bucket", pa.int64()), ("pack", pa.int64())] + [(c, pa.binary()) for c in ("sizes", "leads", "h", "docs", "bytes")]
)


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after another."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
