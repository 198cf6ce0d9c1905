"""Language ID by the nearest centroid.

A text is the vector of its hashed byte n-grams, weighted by TF-IDF and scaled to length 1. Each language has several
centroids, found by clustering its training vectors by cosine. A text gets the language of its nearest centroid, and is
rejected where it lies further from that centroid, by a margin, than all but the oddest texts of its length lie from centroids
of their own language that they had no part in.

The model is fitted on a bounded sample, of which only the vectors come to the driver: ``train_docs`` in all, dealt evenly
over all languages and chosen by a hash of id and text. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.textbytes import by_size, text_bytes

DIMS = 1 << 13
SEED = 1
CHUNK = 4 << 20
UNDETERMINED = "und"
# The share of a language's texts that may be anything (mislabelled, other scripts, code), how many texts of about
# one length are needed to tell, and the size classes: the binary digits of a text's number of n-grams.
ODD, TELLING, SIZES = 0.01, 100, 40
# More values than this are no languages, and refused rather than learned in part.
MOST_LANGS = 8192
# Parts in which a language's least hashes are found before they meet.
SALTS = 64
LETTER = re.compile(r"[^\W\d_]")
# Bytes that are no letters count as space; A-Z count as a-z.
SPACE = np.full(1, 32, np.uint8)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = [ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(128)]


def has_letter(text: str | None) -> bool:
    """Whether any character is of a Unicode category L; fractions and circled digits are none, as in ``fit``."""
    return any(found[0].isalpha() for found in LETTER.finditer(text or ""))


def ngram_counts(data: np.ndarray) -> np.ndarray:
    """How often each hashed n-gram of 2 and 3 bytes occurs, with a space before and after the text.

    N-grams with two spaces in a row don't count.
    """
    counts = np.zeros(DIMS, np.int64)
    data = np.concatenate([SPACE, data, SPACE])
    for at in range(0, max(len(data) - 2, 0), CHUNK):
        b = FOLD[data[at : at + CHUNK + 2]].astype(np.uint32)
        space = b == 32
        apart = ~(space[1:] & space[:-1])
        pairs = (b[:-1] << np.uint32(8)) | b[1:]
        triples = (pairs[:-1] << np.uint32(8)) | b[2:]
        for codes, use in ((pairs[:-1] + np.uint32(1 << 24), apart[:-1]), (triples, apart[:-1] & apart[1:])):
            hashed = (codes[use] * np.uint32(2654435761)) >> np.uint32(32 - DIMS.bit_length() + 1)
            counts += np.bincount(hashed, minlength=DIMS)
    return counts


@dataclass
class Model:
    """``centroids``: a row each, of length 1; ``langs``: of each row; ``limits``: of each row and size class; ``idf``: of each dimension."""

    langs: list[str]
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return weighted(counts, self.idf)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The counts as vectors of length 1. 32-bit counts are overwritten, as the driver holds those of the whole sample."""
    vectors = counts.astype(np.float32, copy=False)
    np.log1p(vectors, out=vectors)
    vectors *= idf
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    vectors /= np.where(length > 0, length, 1)
    return vectors


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.sum(axis=1).astype(float))[1], SIZES - 1)


def clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """The centroids of spherical k-means, which starts from vectors that are far apart.

    The very furthest may be no text of the language at all: seeds leave twice ``ODD`` of the vectors further off, and what
    gathers but a few of many vectors is no centroid.
    """
    centroids = vectors.mean(axis=0, keepdims=True)
    centroids /= max(np.linalg.norm(centroids), 1e-9)
    while len(centroids) < min(k, len(vectors)):
        far = np.argsort((vectors @ centroids.T).max(axis=1), kind="stable")
        centroids = np.vstack([centroids, vectors[far[int(2 * ODD * len(vectors))]]])
    near = (vectors @ centroids.T).argmax(axis=1)
    for _ in range(rounds):
        sums = np.stack([vectors[near == i].sum(axis=0) for i in range(len(centroids))])
        centroids = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9))[np.bincount(near, minlength=len(sums)) > 0]
        moved = (vectors @ centroids.T).argmax(axis=1)
        if len(centroids) == len(sums) and (moved == near).all():
            break
        near = moved
    held = np.bincount((vectors @ centroids.T).argmax(axis=1), minlength=len(centroids))
    least = max(len(vectors) // 64, 2 if len(vectors) >= 8 else 1)
    return centroids[held >= min(least, held.max())]


def left_out(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The cosine of each vector with the nearest centroid as it is without that vector; NaN for the only one."""
    cosines = vectors @ centroids.T
    near = cosines.argmax(axis=1)
    sums = np.stack([vectors[near == i].sum(axis=0) for i in range(len(centroids))])
    own = np.einsum("ij,ij->i", vectors, sums[near]).astype(float)
    rest = np.einsum("ij,ij->i", sums, sums)[near] - 2 * own + 1
    alone = np.bincount(near, minlength=len(centroids))[near] == 1
    cosines[np.arange(len(near)), near] = np.where(alone, np.nan, (own - 1) / np.sqrt(np.maximum(rest, 1e-9)))
    return np.where(np.isnan(cosines).all(axis=1), np.nan, np.nanmax(np.nan_to_num(cosines, nan=-1), axis=1))


def limits_by_size(sizes: np.ndarray, cosines: np.ndarray, langs: np.ndarray, margin: float) -> dict[str, np.ndarray]:
    """Each language's limit by size class: a low quantile of its own texts' cosines, less the margin.

    How cosines fall with length and how far they scatter is told by the texts of all languages, for each class by its own texts
    and as many of the next classes as it takes; a language's level is the median of its texts against that. Without
    any two texts of one language the limit is ``margin`` itself.
    """
    told = ~np.isnan(cosines)
    if not told.any():
        return {name: np.full(SIZES, margin) for name in set(langs)}
    sizes, cosines, owner = sizes[told], np.maximum(cosines[told], 1e-6), langs[told]
    around = []
    for size in range(SIZES):
        apart = np.abs(sizes - size)
        around.append(apart <= np.sort(apart)[min(TELLING, len(apart)) - 1])
    middle = np.array([np.median(cosines[a]) for a in around])
    levels = {name: float(np.median((cosines / middle[sizes])[owner == name])) for name in set(owner)}
    scatter = cosines / (middle[sizes] * np.array([levels[name] for name in owner]))
    low = np.array([np.quantile(scatter[a], ODD) for a in around])
    return {name: (1 - margin) * levels.get(name, 1.0) * middle * low for name in set(langs)}


def fit(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_docs: int = 2048,
    centroids: int = 4,
    margin: float = 0.3,
) -> Model:
    """A model from ``labelled``, whose rows with a null language or a text without any letter count for nothing.

    ``train_docs`` bounds what the driver gets: every language is learned from an equal share of texts with different n-grams, from
    one at least. Over ``MOST_LANGS`` different labels are an error. A language's limit for texts of one size lies ``margin`` of it
    below the cosine that nearly all of its own such texts reach (``limits_by_size``). Without any labelled row the model knows no
    language.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    learned = sorted(row["lang"] for row in rows.select("lang").distinct().limit(MOST_LANGS + 1).collect())
    if not learned:
        return Model([], np.zeros((0, DIMS), np.float32), np.zeros((0, SIZES)), np.ones(DIMS, np.float32))
    if len(learned) > MOST_LANGS:
        raise ValueError(f"{lang} has over {MOST_LANGS} different values")
    each = max(1, train_docs // len(learned))
    placed = rows.withColumn("place", F.xxhash64(F.lit(SEED), "id", "text"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The least hashes of each language that a task has read, copies once.
        best = {name: np.zeros(0, np.int64) for name in learned}
        for batch in batches:
            names, places = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            codes = names.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
                if len(own):
                    name = names.dictionary[int(codes[own[0]])].as_py()
                    best[name] = np.unique(np.concatenate([best[name], places[own]]))[:each]
        found = {name: x for name, x in best.items() if len(x)}
        langs = np.repeat(np.array(list(found), object), [len(x) for x in found.values()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate([np.zeros(0, np.int64), *found.values()]))], ["lang", "place"]
        )

    ranks = "lang string, place long"
    kept_places = placed.select("lang", "place").mapInArrow(least, ranks)
    for keys in (["lang", F.pmod("place", F.lit(SALTS))], ["lang"]):  # no task gets more than SALTS shares of a language at the end
        kept_places = kept_places.repartition(*keys).mapInArrow(least, ranks)
    last = {r["lang"]: r["last"] for r in kept_places.groupBy("lang").agg(F.max("place").alias("last")).collect()}
    up_to = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])[F.col("lang")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()  # at most the sample
        for batch in by_size(batches, "text"):
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            new = {key: i for i, key in reversed(list(enumerate(keys))) if key not in seen}
            seen.update(new)
            batch = batch.take(pa.array(sorted(new.values()), pa.int64()))
            data, bounds = text_bytes(batch.column(0))
            found = [ngram_counts(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            kept = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([k.astype(np.uint16).tobytes() for k in kept], pa.binary()),
                    pa.array([np.minimum(c[k], 2**32 - 1).astype(np.uint32).tobytes() for c, k in zip(found, kept, strict=True)], pa.binary()),
                ],
                ["lang", "place", "dims", "counts"],
            )

    sample = (
        placed.where(F.col("place") <= up_to).select("text", "lang", "place")
        .mapInArrow(count, "lang string, place long, dims binary, counts binary").dropDuplicates(["lang", "place"]).collect()
    )
    sample = sorted({(r["lang"], bytes(r["dims"]), bytes(r["counts"])) for r in sample})
    counts = np.zeros((len(sample), DIMS), np.float32)
    for i, row in enumerate(sample):
        counts[i, np.frombuffer(row[1], np.uint16)] = np.frombuffer(row[2], np.uint32)
    sizes_of = size_class(counts)
    df = np.count_nonzero(counts, axis=0)
    idf = (np.log((1 + len(sample)) / (1 + df)) + 1).astype(np.float32)
    vectors = weighted(counts, idf)
    labels = np.array([r[0] for r in sample])
    langs, middles, cosines = [], [], np.full(len(sample), np.nan)
    for name in sorted(set(labels)):
        own = vectors[labels == name]
        middle = clusters(own, centroids)
        langs += [str(name)] * len(middle)
        middles.extend(middle)
        cosines[labels == name] = left_out(own, middle)
    limits = limits_by_size(sizes_of, cosines, labels, margin)
    by_centroid = np.array([limits[name] for name in langs]).reshape(-1, SIZES)
    return Model(langs, np.array(middles, np.float32).reshape(-1, DIMS), by_centroid, idf)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine with the nearest centroid, 0 to 1) and ``rejected``.

    A null text, one without any letter, or any text under a model without languages is ``und`` with score 0 and rejected.
    Of centroids that are equally near the first language by name wins. Columns of the added names are replaced; every row stays.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    kept = docs.select(names)
    schema = T.StructType(
        kept.schema.fields
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dims x centroids, which are at most train_docs or MOST_LANGS

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in by_size(batches, text, 1 << 20):
            texts = batch.column(batch.schema.get_field_index(text))
            data, bounds = text_bytes(texts)
            lettered = np.array([has_letter(t) for t in texts.to_pylist()], bool)
            pred = np.full(len(lettered), UNDETERMINED, object)
            score, rejected = np.zeros(len(lettered)), np.ones(len(lettered), bool)
            todo = np.flatnonzero(lettered) if m.langs else []
            for at in range(0, len(todo), 128):
                some = todo[at : at + 128]
                counts = np.stack([ngram_counts(data[bounds[i] : bounds[i + 1]]) for i in some])
                near = m.vectors(counts) @ m.centroids.T
                best = near.argmax(axis=1)
                pred[some] = [m.langs[i] for i in best]
                score[some] = np.clip(near[np.arange(len(some)), best].astype(float), 0, 1)
                rejected[some] = score[some] < np.maximum(m.limits[best, size_class(counts)], 1e-6)
            added = [pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return kept.mapInArrow(predict, schema)
