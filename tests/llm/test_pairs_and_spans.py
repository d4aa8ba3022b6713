"""Brute force for the similarity join, the suffix removal and the secret scan, with odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from wavelattice.llm import ngram_join, secrets, suffixes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, n string, gram string, cid string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, None, 0, "x", "y", "z", None) for i, t in rows], SCHEMA)


def prose(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    shared = " ".join(prose(rng, 60))
    rows = [(i, " ".join(prose(rng, rng.randrange(5, 120)))) for i in range(60)]
    base = prose(rng, 150)
    for i in range(60, 110):  # a family of near copies around the threshold
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"e{i}x{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    rows += [(110 + i, shared + " " + " ".join(prose(rng, 80))) for i in range(20)]
    rows += [(130, None), (131, ""), (132, " \t\n"), (133, "one Two"), (134, "ONE two"), (135, "one two"), (136, "a a a a a a a"),
             (137, "a a a a a"), (138, "é" * 300), (139, "é" * 300), (140, "x" * 5000), (141, " ".join(base * 40)),
             (142, " ".join(base * 41)), (-7, "one two")]
    rows += [(200 + i, "same text of many copies that is long enough to be removed as a whole because it has over a hundred bytes in it")
             for i in range(30)]
    return rows


def shingle_set(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)].append(k)
    return sorted(((k, len(sets[i]), min(least[root(i)], default=None)) for i, (k, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [1024, 8])
def test_ngram_join_equals_brute_force(spark, texts, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "FLUSH", 700)
    got = ngram_join.similar_components(frame(spark, texts).repartition(3), block=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_components(texts)


def test_ngram_join_combinations_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIR_FROM", 3)
    monkeypatch.setattr(ngram_join, "TRIPLE_FROM", 6)
    rng = random.Random(9)
    rows = []
    for f in range(12):
        base = prose(rng, rng.choice([6, 9, 14, 30, 80]), 50)
        for _ in range(14):
            words = list(base)
            if rng.random() < 0.8:
                words[rng.randrange(len(words))] = f"z{rng.randrange(4)}"
            rows.append((len(rows), " ".join(words)))
    got = ngram_join.similar_components(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_components(rows)


def test_ngram_join_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (1, "q r s t u"), (None, None), (None, "only here is this text")]
    got = ngram_join.similar_components(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, 2, 1), (1, 2, 1), (None, 2, 1), (1, 1, 1), (None, 0, None), (None, 1, None)], key=str)
    assert ngram_join.similar_components(frame(spark, [])).collect() == []


def expected_removal(rows):
    seen, out = set(), []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            w = raw[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(raw)))
        out.append((k, len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot, segment", [(100_000, 1 << 20), (3, 700)])
def test_suffix_removal_equals_brute_force(spark, texts, hot, segment, monkeypatch):
    monkeypatch.setattr(suffixes, "FLUSH", 300)
    monkeypatch.setattr(suffixes, "CHUNK", 50)
    monkeypatch.setattr(suffixes, "_SEGMENT", segment)
    rng = random.Random(3)
    periodic = "abc" * 200
    rows = texts + [(300, periodic), (301, "q" + periodic[7:250]), (302, "\0" * 400), (303, "\0" * 150),
                    (304, "".join(rng.choice("ab") for _ in range(900)))]
    got = suffixes.remove_repeats(frame(spark, rows).repartition(3), hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_removal(rows)


def test_suffix_removal_repeated_and_null_keys(spark):
    long = "some words that are long enough to make up a hundred bytes when they are written one after the other, twice"
    rows = [(5, long), (5, long), (None, long), (None, None), (2, "head " + long), (5, "")]
    got = suffixes.remove_repeats(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_removal(rows)
    assert suffixes.remove_repeats(frame(spark, [])).collect() == []


def test_two_places_share_a_sample_at_some_distance():
    cover = {int(d) for d in suffixes.COVER}
    for i in range(suffixes.PERIOD):
        for j in range(suffixes.PERIOD):
            assert any((i + k) % suffixes.PERIOD in cover and (j + k) % suffixes.PERIOD in cover for k in range(suffixes.BEFORE + 1))


@pytest.mark.parametrize("shift", [0, 1, 56, 57, 700])
def test_suffix_removal_of_shifted_near_copies(spark, shift, monkeypatch):
    monkeypatch.setattr(suffixes, "_SEGMENT", 900)
    rng = random.Random(shift)
    base = "".join(rng.choice("abcdefgh ") for _ in range(2_000))
    rows = [(0, base)]
    for i in range(1, 12):  # one letter replaced or put in, at any place, behind a head of its own
        at = rng.randrange(len(base))
        rows.append((i, "".join(rng.choice("xyz") for _ in range(shift)) + base[:at] + "Q" + base[at + i % 2:]))
    got = suffixes.remove_repeats(frame(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_removal(rows)


def test_difference_cover_names_windows():
    rng = np.random.default_rng(2)
    texts = rng.integers(97, 99, (60, suffixes.CONTEXT)).astype(np.uint8)
    for i in range(1, 60):  # copy stretches of earlier contexts
        j, a = rng.integers(0, i), rng.integers(0, 60)
        texts[i, a:a + 110] = texts[j, a:a + 110]
    group = rng.integers(0, 3, 60)
    low, high = rng.integers(0, 5, 60), rng.integers(50, suffixes.BEFORE + 1, 60)
    got = suffixes.repeats(texts, group, low, high)
    for i in range(60):
        for s in range(suffixes.BEFORE + 1):
            want = low[i] <= s <= high[i] and any(
                group[j] == group[i] and low[j] <= s <= high[j] and (texts[j, s:s + 100] == texts[i, s:s + 100]).all() for j in range(i))
            assert got[i, s] == want


BASE = {"assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def expected_base(text):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        for m in p.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_secret_spans(spark):
    weak = "aB3" + "xY9/" * 9
    access = "AKIA" + "Q7" * 8
    rng = random.Random(1)
    bits = ["password: ", "Secret='", "tokenToken=", "api_key = ", "apikey:\"", access, "AKIAAKIA" + "Z" * 14, "0123456789abcdef0", "é☃𝄞 ", "deadbeef ",
            "abcdefghijkl", "k_l.m=n-o+p/q", " ", "\n", "'", weak, "https://x.example/a?b=c "]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 30)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "password=abcdefghijklmnop"), (5, "token: zzzzzzzzzzzzzz"), (5, "token: zzzzzzzzzzzzzz"),
             (902, "password = short " * 3 + "secret: password: abcdefghijkl"), (903, "ab12" * 4000), (904, ("0a" * 9 + " ") * 3000)]
    got = secrets.secret_spans(frame(spark, rows)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["base"]]) for r in got), key=key) == sorted(((i, expected_base(t)) for i, t in rows), key=key)
    for r in got:
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_weak_parts_need_company(spark):
    weak, access, url = "aB3" + "xY9/" * 9, "AKIA" + "Q7" * 8, "https://keys.example/v1"
    far = " word" * 200
    rows = [(1, f"{weak} alone"), (2, f"{access} {weak}"), (3, f"{access}{far}{weak}"), (4, f"{url} {access}"), (5, f"{url} {weak} {access}"),
            (6, f"ASIA{'B' * 16} and {weak}"), (7, f"ASIA{'B' * 16} alone")]
    got = {r["doc_id"]: [x["kind"] for x in r["spans"]] for r in secrets.secret_spans(frame(spark, rows)).collect()}
    assert got == {1: [], 2: ["access", "secret"], 3: ["access"], 4: ["access"], 5: ["endpoint", "secret", "access"], 6: ["ident", "secret"], 7: []}


def test_session_tokens_are_secrets_at_any_length(spark):
    token = "aB3" + "xY9/" * 150
    text = f"ASIA{'B' * 16} {'aB3' + 'xY9/' * 9} {token}=="
    rows = [(1, text), (2, f"{token} alone")]
    got = {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["spans"]] for r in secrets.secret_spans(frame(spark, rows)).collect()}
    assert got[1][0] == ("ident", 0, 20) and got[1][-1] == ("secret", text.index(token), len(text)) and len(got[1]) == 3 and got[2] == []


def test_redaction(spark):
    out = secrets.secret_spans(frame(spark, [(1, "é password: abcdefghijklmnop ☃ 0123456789abcdef end"), (2, "plain")]))
    docs = frame(spark, [(1, "é password: abcdefghijklmnop ☃ 0123456789abcdef end"), (2, "plain")]).select("doc_id", "text")
    got = docs.join(out, "doc_id").select("doc_id", secrets.redacted(docs["text"], out["spans"]).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in got} == {1: "é [SECRET] ☃ [SECRET] end", 2: "plain"}
    assert secrets.secret_spans(frame(spark, [])).collect() == []


def test_sql_links_long_tokens_too(spark):
    import duckdb
    import pandas as pd

    token = "Ab1" + "xY9/" * 60
    rows = [(1, f"ASIAABCDEFGHIJKLMNOP with {token} end"), (2, token), (3, None)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = {r[0]: r[5] for r in con.execute(secrets.SQL).fetchall()}
    found = secrets.secret_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", secrets.joined(found["spans"]).alias("s")).collect()}
    assert got == want and "secret" in got[1] and got[2] == got[3] == ""


def test_buckets_are_counted_one_at_a_time(monkeypatch):
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(ngram_join, "FLUSH", 190_000)
    rng = random.Random(3)
    texts = [" ".join(prose(rng, 400, 60000)) for _ in range(500)]
    docs = pa.record_batch({"_id": pa.array(range(1000)), "_t": pa.array(texts * 2)})  # every n-gram is in two texts
    blocks = pa.Table.from_batches(ngram_join._blocks(iter([docs.slice(0, 500), docs.slice(500)]), 6)).sort_by("bucket")

    def run(buckets):
        some = blocks.filter(pa.array(np.isin(blocks["bucket"].to_numpy(), buckets))).combine_chunks().to_batches()
        tracemalloc.start()
        out = list(ngram_join._shared(iter(some)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak, pa.Table.from_batches(out)

    one, _ = run([5])
    all_of_them, shared = run(range(64))
    assert all_of_them < 8 * one
    per = list(ngram_join._counted(iter(shared.sort_by("flush").to_batches())))
    got = {r["doc_id"]: r for b in per for r in b.to_pylist()}
    assert len(got) == 1000 and all(r["shared"] == r["n"] == 396 for r in got.values())


def test_short_batches_are_for_the_block_only(spark):
    from wavelattice.llm.common import arrow_rows
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = "n long"
    count = lambda batches: (b.from_pydict({"n": [b.num_rows]}) for b in batches)
    with arrow_rows(spark, 256):
        assert max(r["n"] for r in spark.range(3000, numPartitions=1).mapInArrow(count, sizes).collect()) == 256
    assert spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), arrow_rows(spark, 256):
        1 / 0
    assert spark.conf.get(key) == before
