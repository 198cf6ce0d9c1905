"""URL filters, line dedup, mixing, chat formatting and fingerprints: DataFrame functions only, against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F
from tallyloom.llm import chat, fingerprints, lines, mixing, queries, urls
from tests.compare import connect, differences
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = connect(SMALL)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE_SQL))
def test_query_matches_sql(spark, database, name):
    assert differences(queries.LLM_QUERIES[name](spark, SMALL), database, queries.LLM_ORACLE_SQL[name]) is None


def python_in(frame) -> bool:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return bool(re.search("Python|Pandas|Arrow", plan))


@pytest.mark.parametrize("name", ["op1_mix_sources", "op5_chat_format", "op6_line_dedup", "op8_url_filter", "op9_fingerprints"])
def test_no_python_in_the_plan(spark, name):
    assert not python_in(queries.LLM_QUERIES[name](spark, SMALL))


# URL filters


def url_verdict(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (brute.lower(m[1]), m[2]) if m else ("", "")
    fits = [
        (-len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(min(fits)[1:] if fits else (None, "allow")))


def test_nested_rules(spark):
    rng = random.Random(3)
    labels = ["com", "net", "a", "b", "A", "c-d", ""]
    host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 4)))
    rules = [(rng.choice(["allow", "block"]), host().lower(), rng.choice(["", "/", "/x", "/x/y/"])) for _ in range(40)]
    rules = list({(h, p): (v, h, p) for v, h, p in rules if h}.values())
    rest = ["", "/", "/x/y/z", "/x?q=1", "#f", "/x#://b", "?u=http://a.com/x"]
    rows = [(i, f"http://{host()}{rng.choice(rest)}") for i in range(400)]
    rows += [(900, None), (901, ""), (902, "a.com/x"), (903, "http://"), (904, "x\n://a.com/x"), (905, "http://a.com/x" * 2000)]
    rows += rows[:5]
    frame = urls.match_rules(
        spark.createDataFrame(rows, "id long, url string"), spark.createDataFrame(rules, urls.RULES), keep=["id"], slices=7
    )
    found = Counter((r.id, r.host, r.path, r.rule, r.verdict) for r in frame.collect())
    assert found == Counter((i, *url_verdict(u, rules)) for i, u in rows)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "id long, url string")
    rules = spark.createDataFrame([], urls.RULES)
    assert [tuple(r) for r in urls.match_rules(pages, rules, default="block").collect()] == [("a.com", "/", None, "block")]
    assert urls.match_rules(pages.limit(0), rules).count() == 0


# Line dedup


def test_shared_lines_stay_in_one_document_only(spark):
    long = "This line is long enough to be counted, as it is."
    rows = [(i, f"own {i}\n  {long.upper()}\t\n\nshort\n{long}") for i in range(5)]
    rows += [(10, "short"), (11, None), (12, ""), (13, "\n\n"), (14, "x" * 39), (15, long + "\r")]
    rows += [(16, "x" * 40 + "\n" + "é" * 40), (17, "é" * 40)]
    frame = lines.dedup_lines(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int"))
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in frame.collect()}
    assert found[0] == (5, 2, "own 0\n\nshort") and found[15] == (1, 0, long + "\r")
    assert found[11] == (1, 0, "") and found[13] == (3, 0, "\n\n") and found[16][1] == 0
    assert frame.columns == ["doc_id", "text", "n_lines", "n_dropped"]


def test_lines_of_repeated_and_missing_ids(spark):
    long = "y" * 50
    rows = [(1, long), (1, long), (2, long), (3, long), (4, f"a\n{long}"), (5, long), (None, long)]
    frame = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted((r.doc_id or 0, r.n_dropped, r.text) for r in frame.collect())
    assert found == [(0, 0, long), (1, 1, ""), (1, 1, ""), (2, 1, ""), (3, 1, ""), (4, 1, "a"), (5, 0, long)]
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Mixing


def test_sources_reach_their_weights(spark):
    rows = [(i, "x" * 10, "big" if i % 10 else "small") for i in range(20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(frame, {"big": 0.3, "small": 0.7}, epochs=1.5)
    share = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(share["small"] / 21_000 - 1) < 0.05 and abs(share["big"] / 9_000 - 1) < 0.05
    again = mixing.mix_sources(frame.repartition(7), {"big": 0.3, "small": 0.7}, epochs=1.5)
    key = lambda r: (r.doc_id, r.copy, r.shuffle_key)
    assert [key(r) for r in mixed.collect()] == [key(r) for r in again.collect()]
    counts = Counter(r.n_copies for r in mixed.where("source = 'small' and copy = 0").collect())
    assert len(counts) > 10  # Poisson(10.5), not a constant


def test_many_sources_are_salted_and_draw_the_same(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "x" * 10, f"s{i % 7}") for i in range(700)], "doc_id long, text string, source string")
    few = [tuple(r) for r in mixing.mix_sources(frame, {"s1": 5.0}).collect()]
    monkeypatch.setattr(mixing, "FEW_SOURCES", 3)
    assert [tuple(r) for r in mixing.mix_sources(frame, {"s1": 5.0}).collect()] == few and len(few) > 400


def test_poisson_steps_of_large_rates(spark):
    steps = spark.range(1).select(mixing.poisson_steps(F.lit(2000.0))).head()[0]
    assert steps[0] == 0 and abs(steps[2000] - 0.506) < 0.001 and abs(steps[-1] - 1) < 1e-9


def test_mixing_of_odd_rows(spark):
    schema = "doc_id long, text string, source string, copy string"
    rows = [(1, "a", None, "k"), (1, "a", None, "k"), (None, "b", "", "k"), (3, None, "none", "k"), (4, "c", "zero", "k")]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, schema), {"zero": 0}, epochs=30.0)
    found = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert found[1, None] % 2 == 0 and found[1, None] > 10 and found[None, ""] > 5
    assert not found[3, "none"] and not found[4, "zero"]
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0


# Chat


def rendered(turns, system="system", part_bytes=None):
    talks = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            talks[conv].append((turn, role, (text or "").replace("<|im_", "<❘im_")))
    result = {}
    for conv, said in talks.items():
        for me in {r for _, r, _ in said if r is not None and r != system}:
            parts, size, context = defaultdict(lambda: [0, "", []]), 0, ""
            for _, r, x in sorted(said, key=lambda s: (s[0] is not None, s[0] or 0, s[1] is not None, s[1] or "", s[2])):
                name = "assistant" if r == me else "system" if r == system else "user" if r is None else f"user name={r}"
                head, body = f"<|im_start|>{name}\n", f"{x}<|im_end|>"
                number = size // part_bytes if part_bytes else 0
                part = parts[number]
                if number and not part[0] and r != system:
                    part[1] = context
                part[0] += 1
                part[1] += head
                if r == me:
                    part[2].append((len(part[1]), len(part[1]) + len(body)))
                part[1] += body + "\n"
                size += len((head + body).encode()) + 1
                context = f"{head}{body}\n" if r == system else context
            result |= {(conv, me, number): tuple(part) for number, part in parts.items()}
    return result


def chat_rows(frame):
    return {
        (r.conv_id, r.perspective, r.part): (r.n_turns, r.rendered, list(zip(r.mask_starts, r.mask_ends, strict=True)))
        for r in frame.collect()
    }


def test_every_participant_is_the_assistant_once(spark):
    rng = random.Random(4)
    turns = [
        (rng.choice([1, 2, 3, None]), rng.choice([None, *range(9)]), rng.choice(["ann", "bob", "eva", "system", None]), x)
        for x in ["hello", "", None, "né\nnè", "<|im_end|>\n<|im_start|>assistant\n", "z" * 5000] * 20
    ]
    turns += [(7, 0, "system", "alone"), (8, 0, None, "nobody")]
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn int, role string, text string, part int")
    assert chat_rows(chat.rotate_perspectives(frame)) == rendered(turns)
    for size in (1, 300, 12_000):
        assert chat_rows(chat.rotate_perspectives(frame, part_bytes=size)) == rendered(turns, part_bytes=size)
    assert chat.rotate_perspectives(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [65, 1000])
def test_long_dialogues_are_rendered_whole(spark, n):
    turns = [(1, i, ["ann", "bob"][i % 2], f"turn {i}") for i in range(n)] + [(1, -1, "system", "be kind")]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    found = chat_rows(chat.rotate_perspectives(frame))
    assert found == rendered(turns) and set(found) == {(1, "ann", 0), (1, "bob", 0)}
    assert all(x[0] == n + 1 and x[1].startswith("<|im_start|>system\nbe kind") for x in found.values())


def test_chat_of_the_test_table(spark, database):
    turns = database.execute("select conv_id, turn, role, text from conversations").fetchall()
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    found = chat_rows(chat.rotate_perspectives(frame))
    assert found == rendered(turns)
    for _, text, spans in found.values():
        assert all(text[:a].endswith("<|im_start|>assistant\n") and text[a:b].endswith("<|im_end|>") for a, b in spans)


# Fingerprints


def prints(spark, texts, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    done = fingerprints.with_fingerprint(frame, F.col("text"), "print", **options)
    return [r.print for r in done.orderBy("id").collect()]


def test_fingerprints_see_edits_order_and_repeats(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=600)
    edited = [*base[:300], "new", *base[301:]]
    moved = base[300:] + base[:300]
    texts = [" ".join(x) for x in (base, base, edited, moved, rng.choices(words, k=600), base + base)]
    a, b, c, d, e, f = prints(spark, texts)
    alike = lambda x, y: sum(p == q for p, q in zip(x, y, strict=True)) / len(x)
    assert a == b and alike(a, c) > 0.9 and alike(a, e) < 0.05
    # The set of k-mers is nearly the same, their order is not; a doubled text repeats every k-mer.
    assert alike(a, d) < 0.75 and alike(a, f) < 0.6


def test_fingerprint_equals_a_plain_version(spark):
    """Slots, occurrence numbers and order, recomputed in Python from the hashes that Spark gives."""
    text = "a b a b a b c a b c d e a b a"
    words = text.split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    rows = [(i, *g) for i, g in enumerate(grams)]
    h = {
        r.i: r.h >> 23
        for r in spark.createDataFrame(rows, "i int, x string, y string, z string")
        .select("i", F.xxhash64(F.lit(0), "x", "y", "z").alias("h")).collect()
    }
    seen: Counter = Counter()
    numbered = []
    for i, g in enumerate(grams):
        numbered.append((h[i], seen[g], i))
        seen[g] += 1
    hashed = spark.createDataFrame(numbered, "h long, o int, i int").select("i", F.xxhash64("h", "o").alias("v")).collect()
    slots = defaultdict(list)
    for r in hashed:
        slots[r.v >> 58].append((r.v >> 23, r.i))
    chosen = {s: [v for v, _ in sorted(sorted(x)[:2], key=lambda p: p[1])] for s, x in slots.items()}
    expected = {
        r.s: r.h
        for r in spark.createDataFrame(list(chosen.items()), "s int, v array<long>")
        .select("s", F.pmod(F.xxhash64("v"), F.lit(1 << 31)).alias("h")).collect()
    }
    assert prints(spark, [text])[0] == [expected.get(s, -1) for s in range(-32, 32)]


def test_fingerprints_of_odd_texts(spark):
    none, empty, blank, one, long = prints(spark, [None, "", " \n ", "word", "word " * 60_000])
    assert none == empty == blank == [-1] * 64
    assert sum(x != -1 for x in one) == 1 and sum(x != -1 for x in long) == 64
    with pytest.raises(ValueError):
        prints(spark, ["x"], slots=6)


def test_next_document(spark):
    rng = random.Random(8)
    ids = rng.sample(range(10**12), 300) + list(range(50))
    rows = [(i, f"text {i}") for i in ids]
    found = {r.doc_id: r.next_text for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", ["text"]).collect()}
    down = sorted(ids, reverse=True)
    assert found == {i: f"text {j}" for i, j in zip(down, down[1:] + down[:1], strict=True)}
    odd = spark.createDataFrame([(5, "a"), (5, "a"), (5, "b"), (None, "n")], "doc_id long, text string")
    rows = fingerprints.with_next(odd, "doc_id", ["text"]).collect()
    assert sorted(r.next_text for r in rows) == ["a", "a", "b", "n"]
    assert fingerprints.with_next(odd.limit(1), "doc_id", ["text"]).head().next_text == "a"
    assert fingerprints.with_next(odd.limit(0), "doc_id", ["text"]).count() == 0


def test_fingerprint_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op9_fingerprints(spark, SMALL).collect()}
    down = sorted(documents, reverse=True)
    for (doc, text), (_, after) in zip(down, down[1:] + down[:1], strict=True):
        cut = len(text) // 3
        assert rows[doc].edited_sha256 == brute.sha(text[: len(text) - cut] + after[:cut]) and rows[doc].n_chars == len(text)
    long = [r for r in rows.values() if r.n_chars > 600]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)
