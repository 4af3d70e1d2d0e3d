"""Filter audit, SimHash near copies and column-sharded Lloyd against plain versions, and on awkward rows."""

import hashlib
import itertools
import math
import re

import numpy as np
import pytest
import xxhash

from voltweave.llm import catalog, centroids, filter_audit, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mask int, part int, fp string, digest int, label int, first int"
LONG = " ".join(f"w{i * 7919 % 40_000}" for i in range(40_000))
ODD = [
    (1, "Ωmega été " + LONG[:900], "en"), (2, None, None), (3, "", ""), (4, "", "en"), (4, "", "en"), (None, None, None), (None, "ABC DEF", "de"),
    (5, "ABC DEF", "de"), (6, " \n\t\x0b ", "de"), (7, LONG, "de"), (8, "one#two", None), (9, "one two", "fr"), (10, "a b c d", "fr"),
    (11, "ab " * 300, "fr"), (0, "ABC DEF", "fr"), (12, "x" * 5000, "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, g, "s", 0, 9, 9, "z", 1, 2, 3) for i, t, g in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


# -- filter audit --------------------------------------------------------------------------------------------------


def brute_audit(rows, good, toxic):
    """Applies the filters of every order one by one to lists of documents."""
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))

    def failing(i, text):
        text = text or ""
        w = split(text)
        return {f for f, hit in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search("[#$%&*|]", text)), i is not None and smallest[text] < i)) if hit}

    out = {}
    for part in {g or "" for *_, g in rows}:
        own = [(i, failing(i, t)) for i, t, g in rows if (g or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def audited(frame):
    return {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in frame.collect()}


def test_audit_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    got = audited(catalog.QUERIES["op11_filter_audit"](spark, sf_dir))
    assert got == brute_audit(rows, {r["doc_id"] for r in labels if r["quality"] == 1}, {r["doc_id"] for r in labels if r["toxic"] == 1})


def test_audit_odd_rows(spark, odd, none):
    """Null ids, texts and langs, repeated rows, labels that are repeated, null or without a document, no rows at all."""
    labels = spark.createDataFrame([(5, 1, 0, 1), (5, None, 1, 1), (None, 1, 1, 1), (99, 1, 1, 1), (4, 0, 1, 1), (7, 1, None, 1)],
                                   "doc_id long, quality int, toxic int, part int")
    assert audited(filter_audit.report(odd, labels)) == brute_audit(ODD, {5, 7}, {5, 4})
    assert audited(filter_audit.report(odd, labels.limit(0))) == brute_audit(ODD, set(), set())
    assert filter_audit.report(none, labels).count() == 0


def test_removal_steps_are_first_failures():
    masks, orders = np.arange(32), np.array(list(itertools.permutations(range(5))))
    steps = filter_audit.removal_steps(masks, np.argsort(orders, axis=1))
    for m in masks:
        for o, order in enumerate(orders):
            assert steps[m, o] == next((s for s, f in enumerate(order) if m >> f & 1), 5)


# -- SimHash -------------------------------------------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    w = split((text or "").translate(LOWER))
    runs = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_near(fps, radius=2):
    """Components of distinct fingerprints, by comparing all with all."""
    distinct = sorted(set(fps))
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array(distinct, dtype=np.uint64)
    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius) + i + 1:
            root[find(int(j))] = find(i)
    return {v: find(i) for i, v in enumerate(distinct)}


def check_near(rows, ids, texts):
    fps = [brute_fingerprint(t) for t in texts]
    label = brute_near(fps)
    smallest = {}
    for i, f in zip(ids, fps):
        if i is not None:
            smallest[label[f]] = min(i, smallest.get(label[f], i))
    expected = sorted((str(i), f"{f:016x}", smallest.get(label[f])) for i, f in zip(ids, fps))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == expected


def test_simhash_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_near(catalog.QUERIES["op12_simhash_dedup"](spark, sf_dir).collect(), *zip(*docs))


def test_simhash_odd_rows(spark, odd, none):
    ids, texts, _ = zip(*ODD)
    check_near(simhash.near_copies(odd).collect(), ids, texts)
    assert simhash.near_copies(none).count() == 0
    nulls = odd.where("doc_id IS NULL AND text IS NULL")
    assert [tuple(r) for r in simhash.near_copies(nulls).collect()] == [(None, "0" * 16, None)]


def family(rng, n, flips):
    """Values around one centre: some bits of it flipped, the same few bits more often."""
    centre = int(rng.integers(0, 1 << 62))
    made = []
    for _ in range(n):
        x = centre
        for b in rng.choice(64, int(rng.integers(0, flips + 1)), replace=False):
            x ^= 1 << int(b)
        made.append(x)
    return made


@pytest.mark.parametrize("crowded", [2, 128])
def test_links_connect_what_is_near(spark, crowded, monkeypatch):
    """Dense families (crowded cells), correlated and constant bits, chains, lone values: the same components."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(crowded)
    fps = [0, 1, 3, 7, *family(rng, 600, 2), *family(rng, 200, 7), *(int(x) for x in rng.integers(0, 1 << 63, 300))]
    fps += [f & ~0xFF0 | (0xFF0 if f & 1 else 0) for f in fps[-150:]]  # nine bits that go together
    signed = sorted({int(np.uint64(f).view(np.int64)) for f in fps})
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(frame, 2).collect()
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert (np.int64(a) ^ np.int64(b)).view(np.uint64).item().bit_count() <= 2
        root[find(a)] = find(b)
    label = brute_near([f % (1 << 64) for f in signed])
    pairs = {(find(f), label[f % (1 << 64)]) for f in signed}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(3)
    costs = rng.random((40, 3, 4)).cumsum(axis=2)
    thresholds, cost = simhash.allocate(costs)
    assert (thresholds.sum(axis=1) == 2 - 3 + 1).all()
    for row, own, c in zip(thresholds, costs, cost):
        options = [sum(own[i, u] for i, u in enumerate(units)) for units in itertools.product(range(4), repeat=3) if sum(units) == 3]
        assert math.isclose(c, min(options)) and math.isclose(c, sum(own[i, t + 1] for i, t in enumerate(row)))


def test_partitions_and_estimates():
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40:50] = bits[:, :1]  # bits that go together share a partition
    r = np.nan_to_num(np.abs(np.corrcoef(bits.T)))
    np.fill_diagonal(r, 0)
    parts = simhash.bit_partitions(r, 3)
    assert sorted(b for p in parts for b in p) == list(range(64)) and {len(p) for p in parts} == {21, 22}
    assert any({0, *range(40, 50)} <= set(p) for p in parts)
    near = simhash.near_counts(np.arange(16), 2)
    for v in range(16):
        assert [near[v, d] for d in range(3)] == [sum(u for u in range(16) if (u ^ v).bit_count() == d) for d in range(3)]
    with pytest.raises(ValueError):
        simhash.links(None, 3)


# -- Lloyd ---------------------------------------------------------------------------------------------------------


def brute_lloyd(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept] if centres else []

    for _ in range(rounds):
        own = assigned()
        for n in range(len(centres)):
            members = [v for (_, v), (_, c) in zip(kept, own) if c == n]
            if members:
                centres[n] = [sum(col) // len(members) for col in zip(*members)]
    own = assigned()
    sums = [sum(d for d, c in own if c == n) for n in range(len(centres))]
    return sorted((str(i), c, d, sums[c], sum(sums), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                  for (i, _), (d, c) in zip(kept, own))


def clustered(frame, **options):
    return sorted((str(r[0]), *r[1:]) for r in centroids.cluster(frame, **options).collect())


def test_lloyd_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = sorted((str(r[0]), *r[1:]) for r in catalog.QUERIES["op13_sharded_lloyd"](spark, sf_dir).collect())
    assert got == brute_lloyd([tuple(r) for r in rows])


def test_lloyd_odd_rows(spark, monkeypatch):
    """Null and repeated ids, equal vectors (ties, empty clusters), vectors left out, fewer vectors than centroids, none."""
    monkeypatch.setattr(centroids, "CHUNK_ROWS", 7)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64)]) for i in range(60)]
    rows += [(i, [0.5] * 64) for i in range(100, 130)] + [(None, [0.25] * 64), (None, rows[0][1]), (3, [-0.001] * 64), (3, [2.0] * 64)]
    rows += [(200, None), (201, [0.1] * 63), (202, []), (203, [0.1] * 63 + [None]), (204, [float("nan")] * 64), (205, [float("inf")] + [0.0] * 63)]
    schema = "vec_id long, embedding array<float>, label int, chunk int, v int"
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], schema)
    assert clustered(frame) == brute_lloyd(rows)
    assert clustered(frame, k=3, rounds=1) == brute_lloyd(rows, 3, 1)
    assert clustered(frame.where("vec_id < 5 OR vec_id >= 200")) == brute_lloyd([r for r in rows if r[0] is not None and (r[0] < 5 or r[0] >= 200)])
    assert clustered(frame.limit(0)) == clustered(frame.where("vec_id IS NULL")) == []
    with pytest.raises(Exception, match="too large"):
        clustered(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<float>"))
