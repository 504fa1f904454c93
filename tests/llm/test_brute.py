"""Operators against brute-force versions on small data."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from chirplens.llm import (
    common,
    decontaminate,
    exact_dedup,
    html_text,
    mixing,
    near_dedup,
    pii,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from chirplens.llm.shingles import WordHashes, shingle_hashes, shingle_set, word_hashes


def vocabulary(rng, n):
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


# --- near duplicates -----------------------------------------------------------------------


def sets_of(rows):
    out = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute_components(rows, percent):
    sets = sets_of(rows)
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in ids}


def family(rng, size, edits):
    base = vocabulary(rng, 150)
    for _ in range(size):
        own = base[:]
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 3)}"
        yield " ".join(own)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, monkeypatch, percent):
    monkeypatch.setattr(near_dedup, "_BLOCK_ROWS", 7)
    monkeypatch.setattr(near_dedup, "_COLUMNS", 16)
    rng = random.Random(percent)
    texts = [t for _ in range(3) for t in family(rng, 40, 9)]
    texts += [" ".join(vocabulary(rng, rng.randint(1, 9))) for _ in range(30)]
    texts += ["A b C d", "a B c D", "a b c d e", None, ""] + texts[:20]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dedup.near_duplicates(frame, percent).collect()
    want = brute_components(rows, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = near_dedup.drop_near_duplicates(frame, percent)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    y = np.concatenate((x[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)))
    a, b = (near_dedup.circulant_signature(v, 400) for v in (x, y))
    assert abs((a == b).mean() - 800 / 1200) < 0.08


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(100, x) for x in range(101, 130)]
    edges += [(200 + k, 201 + k) for k in range(40)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


# --- decontamination -----------------------------------------------------------------------


def sellers(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_least_distance():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))
        assert decontaminate.least_distance(item, text)[0] == sellers(item, text)


def test_leaks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    rng = random.Random(2)
    items = [(k, " ".join(vocabulary(rng, rng.randint(3, 25)))) for k in range(25)]
    docs = []
    for k in range(120):
        words = " ".join(vocabulary(rng, 30))
        if k % 2:
            item = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, len(item) // 12)):
                at = rng.randrange(len(item))
                item[at : at + rng.randint(0, 1)] = rng.choice(["", "x", " ", "Q"])
            words = words[:60] + "\n" + "".join(item).upper() + "  " + words[60:]
        docs.append((k, words))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.find_leaks(frame, bench).collect()}
    want = {}
    for d, t in docs:
        for i, x in items:
            x, t2 = decontaminate.normalized(x), decontaminate.normalized(t)
            n = sellers(x, t2)
            if n <= decontaminate.error_budget(x) and len(x) >= decontaminate.MIN_CHARS:
                want[d, i] = n
    assert got == want and 30 < len(want) < 60
    kept = {r["doc_id"] for r in decontaminate.drop_leaks(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


# --- mixing --------------------------------------------------------------------------------


def reshared(sizes, weights, share, cap):
    """The rule word for word: excess is dealt out again until none is above its limit."""
    total = share * sum(sizes.values())
    target, full = {}, set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        w = sum(weights[s] for s in free)
        target = {s: cap * sizes[s] if s in full else rest * weights[s] / w for s in sizes}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_copies(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "z", "é", "B", "a", "😀", "b2"]
    rows = []
    for k in range(400):
        source = names[min(int(rng.expovariate(0.5)), 7)]
        rows.append((k, "w " * rng.randint(0, 30), source))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(frame).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(r[1].split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = reshared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], abs=1e-5)
        rate = r["target"] / r["source_size"] if r["source_size"] else 1
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 2
    taken = Counter()
    for r in plan:
        taken[r["source"]] += r["size"] * r["copies"]
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.1)
    again = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(frame.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in plan}
    counts = Counter(r["doc_id"] for r in mixing.mix(frame).collect())
    assert counts == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})


def test_given_weights_and_shuffled_join(spark):
    frame = spark.createDataFrame([(k, "a b", "x" if k % 3 else "y") for k in range(90)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("x", 1.0), ("y", 1.0)], "source string, weight double")
    for limit in (0, 1 << 20):
        plan = mixing.mix_plan(frame, weights, share=0.5, cap=10.0, limit=limit).collect()
        assert {(r["source"], r["target"]) for r in plan} == {("x", 45.0), ("y", 45.0)}


# --- sharding ------------------------------------------------------------------------------


def brute_shards(ids, hashes, shards, nodes, slack):
    """Row by row: every arc fills its own shard, then what is left walks on clockwise."""
    places, owners = sharding.ring(shards, nodes)
    room = sharding.capacities(len(ids), shards, slack)
    arcs = {}
    for i in ids:
        arcs.setdefault(int(np.searchsorted(places, hashes[i])) % len(places), []).append(i)
    shard, left = {}, []
    for arc in sorted(arcs):
        rows = sorted(arcs[arc], key=lambda i: (hashes[i], i))
        n = min(len(rows), room[owners[arc]])
        room[owners[arc]] -= n
        shard |= {i: owners[arc] for i in rows[:n]}
        left += [(arc, i) for i in rows[n:]]
    for arc, i in left:
        while not room[owners[arc]]:
            arc = (arc + 1) % len(owners)
        room[owners[arc]] -= 1
        shard[i] = owners[arc]
    return shard


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_shards(spark, slack):
    from pyspark.sql import functions as F

    frame = spark.range(3001).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.xxhash64("id", F.lit(1)).alias("h"))
    hashes = {r["doc_id"]: r["h"] for r in frame.collect()}
    got = sharding.assign(frame, 5, slack, nodes=16).collect()
    want = brute_shards(sorted(hashes), hashes, 5, 16, slack)
    assert {r["doc_id"]: r["shard"] for r in got} == want
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) <= max(sharding.capacities(3001, 5, slack))
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    moved = {r["doc_id"]: r["shard"] for r in sharding.assign(frame, 6, slack, nodes=16).collect()}
    assert sum(moved[i] != want[i] for i in want) < 0.6 * len(want)


def test_shards_of_one_hot_id(spark):
    rows = [(1, "same")] * 900 + [(k, "t") for k in range(2, 300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.assign(frame, 4, nodes=8, bucket_rows=20).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in counts.items())


# --- exact duplicates ----------------------------------------------------------------------


def test_exact_duplicates(spark):
    rng = random.Random(3)
    texts = ["hot"] * 300 + [rng.choice(["a", "A", " a", "b", None, ""]) for _ in range(60)] + vocabulary(rng, 300)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    got = exact_dedup.exact_duplicates(frame).collect()
    want = {
        (i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in rows
    }
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    kept = exact_dedup.drop_copies(frame, limit=0)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_filter_finds_every_repeated_hash(spark):
    from pyspark.sql import functions as F

    frame = spark.range(5000).select(F.xxhash64(F.col("id") % 4000).alias("h")).repartition(5)
    bits = exact_dedup.repeated_cells(frame, 16)
    marked = frame.withColumn("m", exact_dedup.may_repeat(F.col("h"), bits, 16, frame))
    counts = {(r["h"], r["m"]): r["count"] for r in marked.groupBy("h", "m").count().collect()}
    assert all(m for (_, m), n in counts.items() if n > 1)
    assert sum(not m for _, m in counts) > 1500


# --- passages ------------------------------------------------------------------------------


def test_compact_windows():
    rng = random.Random(1)
    for _ in range(200):
        n, t = rng.randint(1, 25), rng.randint(1, 6)
        h = np.array([rng.randint(0, 5) << 30 for _ in range(n)], np.uint64)
        cover = {}
        for a, c, b in zip(*substring_dedup.compact_windows(h, np.array([0]), np.array([n]), t), strict=True):
            for i in range(a, c + 1):
                for j in range(max(c, i + t - 1), b + 1):
                    assert (i, j) not in cover
                    cover[i, j] = c
        assert cover == {(i, j): i + int(np.argmin(h[i : j + 1])) for i in range(n) for j in range(i + t - 1, n)}


def test_passages(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_CHUNK", 700)
    rng = random.Random(5)
    docs, planted = [], set()
    for _ in range(20):
        passage = vocabulary(rng, 55)
        for _ in range(rng.randint(2, 5)):
            planted.add(len(docs))
            docs.append(vocabulary(rng, rng.randint(0, 200)) + passage + vocabulary(rng, rng.randint(0, 200)))
    short = vocabulary(rng, 40)
    docs += [vocabulary(rng, rng.randint(1, 300)) + short for _ in range(60)]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for limit in (0, 1 << 20):
        links = substring_dedup.repeated_passages(frame, limit=limit).collect()
        assert {r["doc_id"] for r in links} | {r["other_id"] for r in links} == planted
        for r in links:
            assert r["other_id"] < r["doc_id"] and r["end"] - r["start"] >= 50
            x = shingle_set(" ".join(docs[r["doc_id"]][r["start"] : r["end"]]), WordHashes())
            y = shingle_set(" ".join(docs[r["other_id"]][r["other_start"] : r["other_end"]]), WordHashes())
            both = len(np.intersect1d(x, y))
            assert both / (len(x) + len(y) - both) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8


def test_edited_passage():
    rng = random.Random(6)
    p = vocabulary(rng, 100)
    q = p[:40] + ["new"] + p[40:]
    a, b = (shingle_hashes(word_hashes(" ".join(t), WordHashes())) for t in (vocabulary(rng, 80) + p, q + vocabulary(rng, 80)))
    (found,) = substring_dedup.passages(a, b, 46, 80)
    assert found[0] == 80 and found[1] - found[0] == 96 and found[4] > 0.9
    assert substring_dedup.without_words("a  b\tc d", [(1, 3)]) == "a   d"


def test_edits_at_every_place_of_a_passage():
    rng = random.Random(7)
    hashed = lambda t: shingle_hashes(word_hashes(" ".join(t), WordHashes()))
    tried = 0
    for size in (55, 60, 72, 100):
        for at in range(size):
            p = vocabulary(rng, size)
            for q in (p[:at] + ["new"] + p[at + 1 :], p[:at] + ["new"] + p[at:], p[:at] + p[at + 1 :]):
                a, b = hashed(p), hashed(q)
                both = len(np.intersect1d(a, b))
                if both < 0.8 * (len(a) + len(b) - both):
                    continue
                tried += 1
                x = hashed(vocabulary(rng, 40) + p + vocabulary(rng, 30))
                y = hashed(vocabulary(rng, 20) + q + vocabulary(rng, 50))
                found = substring_dedup.passages(x, y, 46, 80)
                assert found, (size, at)
                for i, j, u, v, s in found:
                    same = len(np.intersect1d(x[i:j], y[u:v]))
                    assert min(j - i, v - u) >= 46
                    assert s == same / (len(np.unique(x[i:j])) + len(np.unique(y[u:v])) - same) >= 0.8
    assert tried > 500


@pytest.mark.parametrize("percent", [60, 80])
def test_passages_are_found_where_there_are_any(percent):
    rng, least, some = random.Random(8), 5, 0

    def like(u, v):
        return 100 * len(u & v) >= percent * len(u | v)

    for _ in range(300):
        # Every shingle once in a text, as in prose, with the order partly broken.
        x = rng.sample(range(16), rng.randint(5, 12))
        y = rng.sample(range(40, 60), 2) + [v if rng.random() < 0.8 else 100 + v for v in x]
        if rng.random() < 0.5:
            y[3:6] = y[5:2:-1]
        stretches = lambda t: [set(t[i:j]) for i in range(len(t)) for j in range(i + least, len(t) + 1)]
        expected = any(like(u, v) for u in stretches(x) for v in stretches(y))
        found = substring_dedup.passages(np.array(x, np.uint64), np.array(y, np.uint64), least, percent)
        assert bool(found) == expected, (x, y)
        some += expected
    assert 30 < some < 290



# --- tokens --------------------------------------------------------------------------------


def test_tokens_equal_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    letters = "abcdefgh ,.'\n\t  éß😀日\x00 　\x1c09"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += ["a" * 3001, "don't we'll I'M", "<|endoftext|>x <|endoftext|><|endoftext|>", "<|endoftext|", "\r\n \r\n", " "]
    folder = "/root/testdata/sf0.001/documents.parquet"
    if os.path.exists(folder):
        texts += [r["text"] for r in spark.read.parquet(folder).collect()]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    counter = token_counts.TokenCounter(P.path("byte_bpe_50k.json"), P.PATTERN)
    assert counter.counts(texts) == want
    small = token_counts.TokenCounter(P.path("byte_bpe_50k.json"), P.PATTERN)
    small_known = token_counts.KNOWN_WORDS
    try:
        token_counts.KNOWN_WORDS = token_counts.TEXT_CHARS = 50
        assert small.counts(texts) == want
    finally:
        token_counts.KNOWN_WORDS, token_counts.TEXT_CHARS = small_known, 1 << 20


# --- personal data -------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans():
    rng = random.Random(8)
    for alphabet in ("a@.1 +-()2b%45", "0123456789 -", "1.2 50"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert pii.base_spans(text) == plain_spans(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_field_learns_other_forms():
    rng = random.Random(9)
    rows = []
    for k in range(60):
        left, right = " ".join(vocabulary(rng, 3)), " ".join(vocabulary(rng, 3))
        n = [f"{rng.randint(200, 999)}", f"{rng.randint(200, 999)}", f"{rng.randint(1000, 9999)}"]
        rows += [
            (k, "phone", left, f"+1 ({n[0]}) {n[1]}-{n[2]}", right),
            (k, "email", left, f"ab.{k}@mail{k}.example.com", right),
            (k, "ip", left, f"{n[0][0]}.{k}.{n[1][:2]}.{n[2][:2]}", right),
        ]
    model = pii.fit(pii.training_windows(rows))
    text = "please call (948) 555-8379 or write to bob at mail dot example dot com before 2024-01-31, order 20240131"
    base, seen = pii.all_spans(text, model)
    assert base == []
    assert {(k, text[a:b]) for k, a, b in seen} == {("phone", "(948) 555-8379"), ("email", "bob at mail dot example dot com")}
    assert pii.masked(text, seen).startswith("please call [phone] or write to [email] before")
    mail = "x a@b.com y"
    assert pii.all_spans(mail, model)[0] == [("email", 2, 9)] and ("email", 2, 9) in pii.all_spans(mail, model)[1]


def test_best_segmentation_is_best():
    rng = random.Random(10)
    for _ in range(100):
        n = rng.randint(1, 7)
        spans = []
        for i in range(n):
            for j in range(i + 1, n + 1):
                if rng.random() < 0.5:
                    spans.append(pii.Candidate(i, j, "ip", i, j, (f"{i}-{j}",)))
        model = pii.SemiCrf({f"{c.first}-{c.past}": rng.uniform(-1, 1) for c in spans})

        def best(t, spans=spans, model=model, n=n):
            if t >= n:
                return 0.0
            return max([best(t + 1)] + [model.score(c) + best(c.past) for c in spans if c.first == t])

        got = model.best(n, spans)
        assert sum(model.score(c) for c in got) == pytest.approx(best(0))
        assert all(x.past <= y.first for x, y in zip(got, got[1:], strict=False))


# --- pages ---------------------------------------------------------------------------------


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 26, 8])
def test_alignment(monkeypatch, bits):
    monkeypatch.setattr(html_text, "_TRACE_BITS", bits)
    rng = random.Random(2)
    for _ in range(1000):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = html_text.shared_lines(a, b)
        rest = iter(b)
        assert got == sorted(set(got)) and len(got) == lcs(a, b) and all(a[i] in rest for i in got)


def test_differencing_decides_beside_an_article(spark):
    """What stands outside of an article is kept if the neighbour does not have it."""
    def page(own, story):
        return f"<div>Our site</div><div>{own}</div><article><p>{story}<p>As ever</article><div>All rights</div>"

    rows = [(i, f"http://a.org/{i}", page(f"Lead {i}", f"Story {i}")) for i in range(4)]
    rows.append((9, "http://alone.org/", page("Lead 9", "Story 9")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_main_text(frame).collect()}
    assert got == {**{i: f"Lead {i} Story {i} As ever" for i in range(4)}, 9: "Story 9 As ever"}


def test_page_lines():
    page = """<!DOCTYPE html><title>t</title><style>p{}</style><script>var a="</p>";</script><nav><ul><li>menu</ul></nav>
      <div class="top-banner">buy<div>now</div></div><!-- <p>no --><header>site</header><main><h1>Title</h1>
      <p>One &amp; <b>t</b>wo&nbsp;&#x33;<br>four<p title="a>b">five</p><aside>side</aside><div id=comments><p>reader</div>
      <form><p>mail</form></main><footer>&copy;</footer>"""
    assert html_text.page_lines(page) == [(True, "Title"), (True, "One & two 3 four"), (True, "five")]
    assert html_text.page_lines('<div class="ad">x<article><p>in</article>') == [(True, "in")]


def test_shared_lines_of_near_pages_go(spark, monkeypatch):
    monkeypatch.setattr(html_text, "RANGE_PAGES", 10)
    pages = []
    for k in range(60):
        host = "big.example" if k % 3 else f"h{k}.example"
        body = f"<div>Site name</div><p>own text {k} a</p><div>More on this site</div><p>own text {k} b</p>"
        pages.append((k, f"http://{host}/p/{k:03}", body))
    pages.append((100, "http://big.example/x", f"<article><p>Site name</p><p>body</p></article>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(frame).collect()}
    for k in range(60):
        own = f"own text {k} a", f"own text {k} b"
        if k % 3:
            assert got[k] == " ".join(own)
        else:
            assert got[k] == f"Site name {own[0]} More on this site {own[1]}"
    assert got[100] == "Site name body"
    again = {r["page_id"]: r["text"] for r in html_text.extract_main_text(frame.repartition(2)).collect()}
    assert again == got


# --- toxicity ------------------------------------------------------------------------------


def labelled(spark, rng, n=1500):
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(["tree", "house", "river", "stone", "cloud", "light"], k=rng.randint(3, 30))
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        # A biased sample: toxic sentences name one group far more often.
        if rng.random() < (0.6 if toxic else 0.05):
            words.insert(0, "muslims")
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_neutral_mentions(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, random.Random(11))
    fair = toxicity.fit(docs, labels, fairness=5.0)
    plain = toxicity.fit(docs, labels, fairness=0.0)
    scored = toxicity.with_score(docs, fair).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in scored)
    assert len(scored) > 200 and right / len(scored) > 0.97

    def gap(model):
        a, b = np.log(toxicity.score_texts(["the muslims live here", "the jews live here"], model) ** -1 - 1)
        return abs(a - b)

    assert gap(fair) < 0.2 * gap(plain)
    assert toxicity.score_texts([""], fair)[0] < 0.5 > toxicity.score_texts(["the muslims live here"], fair)[0]


def test_held_out_labels_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, random.Random(12), 600)
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)
