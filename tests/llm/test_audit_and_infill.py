"""Filter audit and fill-in-middle against SQL, brute force and exact round trips, with odd rows."""

import hashlib
import itertools
import random

import duckdb
import pandas as pd
import pytest

from wavelattice.llm import filter_audit, infill

DOCS = ("doc_id bigint, text string, source string, part string, same string, mask string, _row string, n string, form string, "
        "good string, _id string")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, *"abcdefgh") for i, t, s in rows], DOCS)


def odd_rows():
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma", "D#", "e", "é", "THE", "x|y", " wide", "🙂"]
    texts = [" ".join(rng.choices(words[:rng.randrange(1, 10)], k=rng.randrange(0, 90))) for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "hot", "hot", "hot", None, ""])) for i in range(300)]
    rows += [(500, None, "a"), (501, "", "a"), (501, "", "a"), (7, "same id, other text", "a"), (None, texts[0], None), (None, texts[0], "a"),
             (502, "w\x0bx\x0cy\tz " * 20000, "long"), (-3, texts[1], "hot")]
    return rows + [(1000 + i, texts[2], "hot") for i in range(200)]


# --- filter audit

def test_audit_equals_sql_on_odd_rows(spark):
    rows = odd_rows()
    marks = [(i, i % 3 == 0 or None, i % 7 == 0) for i in range(0, 1200, 2)] + [(4, True, None), (4, False, True), (None, True, True)]
    labels = spark.createDataFrame([(i, q if q is None else int(q), t if t is None else int(t), "x") for i, q, t in marks],
                                   "doc_id bigint, quality int, toxic int, part string")
    got = filter_audit.audit(filter_audit.weighted_masks(docs_of(spark, rows).repartition(5), labels))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame([r[:3] for r in map(tuple, labels.collect())], columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    cur = con.execute(filter_audit.SQL)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r) for r in cur.fetchall())
    assert sorted(map(tuple, got.select(*names).collect())) == want and len(want) == 600 * 4


@pytest.mark.parametrize("seed", range(4))
def test_every_order_equals_direct_counting(seed):
    rng = random.Random(seed)
    masks = {m: (rng.randrange(1, 50), rng.randrange(5), rng.randrange(5)) for m in rng.sample(range(16), rng.choice([1, 3, 9, 16]))}
    got = {(r[1], r[2]): r[3:] for r in filter_audit.order_rows("p", masks, "ABCD")}
    assert len(got) == 24 * 4
    share = dict.fromkeys("ABCD", 0)
    for order in itertools.permutations("ABCD"):
        left = dict(masks)
        for step, f in enumerate(order, 1):
            bit = 1 << "ABCD".index(f)
            out = {m: w for m, w in left.items() if m & bit}
            left = {m: w for m, w in left.items() if not m & bit}
            removed = sum(w[0] for w in out.values())
            share[f] += removed
            assert got["".join(order), step][:6] == (
                sum(w[0] for w in left.values()), removed, sum(w[0] for m, w in masks.items() if m & bit) - removed,
                masks.get(bit, (0,))[0], sum(w[1] for w in out.values()), sum(w[2] for w in out.values()))
    assert all(r[6] == share[order[step - 1]] for (order, step), r in got.items())


def test_orders_differ_by_one_swap_of_neighbours():
    seen = list(filter_audit.adjacent_orders(5))
    assert len({o for o, _ in seen}) == 120 == len(seen)
    for (a, _), (b, i) in zip(seen, seen[1:]):
        assert a[:i] + (a[i + 1], a[i]) + a[i + 2:] == b


def test_swapped_diagram_equals_one_built_in_that_order():
    rng = random.Random(2)
    masks = {m: (rng.randrange(1, 9), 0, 0) for m in rng.sample(range(32), 17)}
    diagram = filter_audit.Diagram(masks, 5)
    for order, level in filter_audit.adjacent_orders(5):
        if level is not None:
            diagram.swap(level)
        relabelled = {sum((m >> f & 1) << i for i, f in enumerate(order)): w for m, w in masks.items()}
        assert tuple(diagram.order) == order and diagram.root == filter_audit.Diagram(relabelled, 5).root


def test_audit_of_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(filter_audit.weighted_masks(docs_of(spark, []), labels)).collect() == []
    one = filter_audit.audit(filter_audit.weighted_masks(docs_of(spark, [(1, None, None)]), labels)).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and {r["removed"] for r in one if r["filter_order"][r["step"] - 1] == "A"} == {1}


# --- fill-in-middle

def by_definition(doc_id, text, seed="1"):
    text = text or ""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return (doc_id, n, form, a, b - a, sha(out), sha(text))


def key_of(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("size", [1, 2, 3, 7, infill.PIECE_CHARS])
def test_pieces_of_any_size_give_the_same_output(spark, size):
    rows = [r[:2] for r in odd_rows() if not r[1] or len(r[1]) < 300] + [(i, "<" * (i % 9) + "P>é🙂 <P" * (i % 5)) for i in range(700, 760)]
    rows += [(800 + i, f"has {m} within" * 3) for i, m in enumerate(("<P>", "<S>", "<M>", "<p>"))]
    got = infill.infilled(docs_of(spark, [(*r, "s") for r in rows]).repartition(5), size=size)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(key_of, got.collect())) == sorted(key_of(by_definition(*r)) for r in rows)


def test_very_long_text_and_many_batches(spark):
    rows = [(i, "long 🙂 text " * 120_000) for i in range(4)] + [(i, f"short {i}") for i in range(10, 3000)]
    got = infill.infilled(docs_of(spark, [(*r, "s") for r in rows])).collect()
    assert sorted(map(key_of, got)) == sorted(key_of(by_definition(*r)) for r in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_parts_are_read_from_the_output_alone():
    for form, out in (("psm", "<P>ab<S>c<d><M>e<"), ("spm", "<S><P><M>x"), ("psm", "<P><S><M>"), ("plain", "a<P")):
        for size in range(1, 8):
            found = infill.parts_of(form, iter([out[i:i + size] for i in range(0, len(out), size)]))
            whole = "".join(p for _, p in sorted(found))
            assert whole == {"<P>ab<S>c<d><M>e<": "abe<c<d>", "<S><P><M>x": "x", "<P><S><M>": "", "a<P": "a<P"}[out]


def test_infill_of_nothing(spark):
    assert infill.infilled(docs_of(spark, [])).collect() == []
