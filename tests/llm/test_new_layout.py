"""Benchmark passages, vector codes and the manifest against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from taleweave.llm import codebooks, decontaminate, manifest

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- benchmark passages

def hits_of(text, items):
    text = text or ""
    found = list(WORD.finditer(lowered(text)))
    words = [m.group() for m in found]
    hit, names = set(), set()
    for item, body in items:
        own = WORD.findall(lowered(body))
        size = min(10, len(own))
        for s in range(max(len(own) - 9, 1) if own else 0):
            window = own[s:s + size]
            for at in range(len(words) - size + 1):
                if words[at:at + size] == window:
                    hit.update(range(at, at + size))
                    if item is not None:
                        names.add(str(item))
    return len(words), hit, sorted(names), found


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["naïve", "汉字", "x9"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(30)]
    items += [(7, "another one under the same id and with quite enough words to be cut"), (None, "no id at all"), (40, None),
              (41, ""), (42, "W1."), (43, items[3][1]), (9, items[9][1])]
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            body.insert(rng.randint(0, len(body)), rng.choice(items)[1] or "")
        docs.append((i, rng.choice([" ", ", ", "\n-"]).join(body).upper() if i % 3 else " ".join(body)))
    return items, docs


def check_hits(spark, make, items, docs):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    got = decontaminate.contaminated(make(docs), spark.createDataFrame(items, schema)).collect()
    assert len(got) == len(docs)
    want = sorted((repr(i), *hits_of(t, items)[:1], len(hits_of(t, items)[1]), hits_of(t, items)[2]) for i, t in docs)
    assert sorted((repr(r["row"]["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in got) == want
    for r in got:  # the spans hold just the words that are hit, in the original text
        n, hit, _, found = hits_of(r["row"]["text"], items)
        text = r["row"]["text"] or ""
        inside = {i for i, m in enumerate(found) for s in r["hits"] if s["start"] <= m.start() and m.end() <= s["stop"]}
        assert inside == hit
        for s in r["hits"]:
            assert text[s["start"]:s["stop"]].strip() == text[s["start"]:s["stop"]] != ""
    return got


def test_passages_equal_brute_force(spark, make, passages, odd):
    items, docs = passages
    assert any(r["n_hit"] for r in check_hits(spark, make, items, docs))
    check_hits(spark, make, [*items, (50, "The cat, it sat on the mat"), (51, "the cat the cat")], [*docs, *odd[:3], *odd[6:], (5, "the cat " * 300)])
    check_hits(spark, make, [], docs[:5])
    check_hits(spark, make, [(1, None), (2, "...")], docs[:5])
    check_hits(spark, make, items, [])


def test_passages_in_several_automata(spark, make, passages, monkeypatch):
    items, docs = passages
    monkeypatch.setattr(decontaminate, "PART_PAIRS", 40)
    check_hits(spark, make, items, docs)


def test_passages_keep_given_columns(spark, make):
    from pyspark.sql import functions as F

    docs = make([(1, "one two three")])
    for name in ("row", "_text", "hits", "n_hit", "items", "n_words"):
        docs = docs.withColumn(name, F.lit(name))
    items = spark.createDataFrame([("i", "two THREE")], "item_id string, text string")
    r = decontaminate.contaminated(docs, items).first()
    assert r["row"].asDict()["hits"] == "hits" and r["n_hit"] == 2 and r["items"] == ["i"]


# ---- vector codes

def codes_of(rows, rounds=4):
    kept = [(k, e, l) for k, e, l in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    if not kept:
        return {}, []
    w = [[int(np.floor(1024 * float(np.float32(x)))) for x in e] for _, e, _ in kept]
    width = -(-max(map(len, w)) // 4)
    w = np.array([x + [0] * (4 * width - len(x)) for x in w], object).reshape(len(kept), 4, width)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], w[i].ravel().tolist()))[:256]
    books = w[order].transpose(1, 0, 2).copy()

    def assign():
        d = ((w[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        best = np.array([[min(range(len(order)), key=lambda e: (d[i, p, e], e)) for p in range(4)] for i in range(len(w))])
        return best, np.take_along_axis(d, best[:, :, None], 2)[:, :, 0]

    for _ in range(rounds):
        best, _ = assign()
        for p in range(4):
            for e in set(best[:, p]):
                own = w[best[:, p] == e, p]
                books[p, e] = own.sum(axis=0) // len(own)
    best, dist = assign()
    errors = dist.sum(axis=1)
    by_label = {}
    for (_, _, l), x in zip(kept, errors):
        by_label[l] = by_label.get(l, 0) + x
    digest = sha(",".join(str(x) for x in books.ravel().tolist()))
    return digest, sorted((repr(k), "".join(f"{c:02x}" for c in b), int(x), by_label[l])
                          for (k, _, l), b, x in zip(kept, best, errors))


SCHEMA = "vec_id long, embedding array<float>, label int"


def check_codes(spark, rows):
    got = codebooks.encode(spark.createDataFrame(rows, SCHEMA)).collect()
    digest, want = codes_of(rows)
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} <= {digest}


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), None if i % 7 == 0 else i % 3) for i in range(400)]
    check_codes(spark, rows)


def test_codes_of_ties_and_odd_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.01, 0.0, 0.002]) for _ in range(8)], 1) for i in range(300)]
    rows += [(3, rows[3][1], 1), (None, rows[4][1], None), (900, None, 2), (901, [None] * 8, 2), (902, [float("nan")] * 8, 2),
             (903, [float("inf")] + [0.0] * 7, 2), (904, [], 5), (905, [0.5, 0.25, 1.0], 5)]
    rng.shuffle(rows)
    check_codes(spark, rows)
    monkeypatch.setattr(codebooks, "FREQUENT_LABELS", 1)  # the rest of the labels by a shuffle
    check_codes(spark, rows)
    check_codes(spark, rows[:9])
    check_codes(spark, [(1, [], 1)])
    assert codebooks.encode(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


def test_orchard_is_exact():
    rng = np.random.default_rng(1)
    for width, scale, n in ((1, 5, 256), (2, 40, 100), (16, 300, 256), (3, 2, 1)):
        entries = rng.integers(-scale, scale, (n, width))
        queries = rng.integers(-scale, scale, (500, width))
        best, dist = codebooks.Orchard(entries).search(queries)
        d = ((queries[:, None] - entries) ** 2).sum(axis=2)
        assert (best == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="components beyond"):
        codebooks.encode(spark.createDataFrame([(1, [1e30] * 4, 1)], SCHEMA)).collect()


# ---- manifest

def node(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out.append((level[first:at], level[at + 1:first + 8]))
        at //= 8
    return out


def folded(digest, steps):
    for a, b in steps:
        digest = sha("".join([*a, digest, *b]))
    return digest


def manifest_of(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        changed = (*r[:4], lowered(r[4]) if hit and r[4] is not None else r[4])
        groups.setdefault(r[2], []).append((r[0], *(sha("".join(map(node, x))) for x in (r, changed))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(climb([x[1] for x in groups[g]]))
    top = climb([t[-1][0] for t in trees])
    out = []
    for i, g in enumerate(names):
        for at, (key, leaf, changed) in enumerate(groups[g]):
            steps = siblings(trees[i], at) + siblings(top, i)
            root = folded(changed, steps)
            assert folded(leaf, steps) == top[-1][0]
            out.append((repr(key), leaf, trees[i][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in steps)), root,
                        root == top[-1][0]))
    return sorted(out)


def check_manifest(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest.manifest(manifest.document_leaves(docs), **options)
    got = sorted((repr(r["doc_id"]), *(r[c] for c in got.columns[1:])) for r in got.collect())
    assert got == manifest_of(rows)
    return got


def tree_rows(counts):
    return [(i * 7, "s", lang, i, f"Text {i} of {lang}" if i % 5 else None) for lang, n in counts.items() for i in range(n)]


@pytest.mark.parametrize("depth", [1, 4])
def test_manifest_equals_brute_force(spark, depth):
    # depth 1 takes four storeys of blocks
    got = check_manifest(spark, tree_rows({"de": 1, "en": 700, "fr": 64, "es": 65, None: 9, "": 2}), depth=depth)
    assert {r[-1] for r in got} == {True, False}
    check_manifest(spark, tree_rows({str(i): 1 + i % 3 for i in range(20)}), depth=depth)


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", "en", 3, "ABC"), (None, "s", "en", 3, "ABC"), (9, "s", "en", 0, ""),
            (9, "s", "en", 5, "Éé汉字A"), (9, "s", "en", 5, "Éé汉字A"), (12, "s", "én", 1, "X" * 200_000)]
    check_manifest(spark, rows + [(i, "s", "en", 3, "ABC") for i in range(40)])
    check_manifest(spark, rows[:1])
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest.manifest(manifest.document_leaves(docs.limit(0))).count() == 0


def test_versions_share_untouched_nodes():
    tree = manifest.PathTree([sha(str(i)) for i in range(100)])
    version = tree.changed(37, sha("x"))
    want = climb([sha("x") if i == 37 else sha(str(i)) for i in range(100)])
    for level, nodes in enumerate(want):
        for i, digest in enumerate(nodes):
            assert version.node(level, i) == digest
            if i != 37 // 8 ** level:
                assert version.node(level, i) is tree.levels[level][i]
    assert version.root == want[-1][0] and tree.root != version.root
