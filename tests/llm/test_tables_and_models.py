"""Mixing, top-k, chat formatting, archives, classifiers, decontamination and the pipeline, with odd rows."""

import gzip
import hashlib
import io
import json
import os
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavelattice.llm import chat, decontam, langid, mixing, topk, toxicity, warc
from wavelattice.llm.common import crc_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, target string, score string, _h string, _text string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "a", "b", "c", "d", "e") for i, t, lang, source in rows], DOCS)


# --- mixing

def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "en", rng.choice(["a", "b", "Z", None, "é", "huge", "huge", "huge"])) for i in range(600)]
    rows += [(900, None, None, "a"), (901, "", None, "only empty"), (None, "some words here", "en", "a"), (None, None, None, None), (7, "same id", "en", "b")]
    got = mixing.mix_sources(docs_of(spark, rows)).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs_of(spark, rows).repartition(7)).collect()))
    total, share = sum(r["size"] for r in got), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = share.setdefault(r["_src"], [0, r["source_size"], r["target"], 0])
        s[0] += r["size"]
        s[3] += r["taken"]
    names = sorted((s for s in share if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, capped = {}, set()
    while True:
        left = total - sum(3 * share[s][1] for s in capped)
        rest = [s for s in names if s not in capped]
        want = {s: 3 * share[s][1] for s in capped} | {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        more = {s for s in rest if want[s] > 3 * share[s][1]}
        if not more:
            break
        capped |= more
    for s, (size, source_size, target, taken) in share.items():
        assert size == source_size and target == pytest.approx(want[s]) and abs(taken - target) <= 3
    assert mixing.mix_sources(docs_of(spark, [])).collect() == []


def test_mixing_ties_share_the_cut(spark):
    rows = [(1, "a b c d", "en", "x")] * 50 + [(2, "q " * 400, "en", "y")]
    got = mixing.mix_sources(docs_of(spark, rows)).collect()
    assert len({r["taken"] for r in got if r["doc_id"] == 1}) == 1


# --- top-k

VEC = "vec_id bigint, embedding array<double>, rank string, score string, _v string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VEC)


def brute_top(rows, queries, k):
    ok = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in (x for x in ok if x[0] in queries):
        best = sorted((-sum(s * t for s, t in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, [0.5, -0.25, 0.0, 1.0, 0.0, 0.0]) for i in range(60)]
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (520, [0.0] * 6),
             (540, [0.001] * 6), (560, [2.0, 1.0]), (561, [1.0, 1.0]), (580, []), (None, [1.0] * 6), (600, [-3e9, 2e9, 1e9, 0.0, 0.0, 0.0])]
    df = vectors_of(spark, rows)
    wanted = {i for i, _ in rows if i is not None and i % 20 == 0}
    for shard in (8192, 37):
        got = topk.top_k(df, df.where(F.col("vec_id") % 20 == 0), k=7, shard_rows=shard)
        assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, wanted, 7)
    twice = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0, 0.0]), (1, [1.0, 2.0]), (2, [-1.0, 3.0]), (3, [0.5, 0.5]), (4, [1.0, 0.0, 2.0])]
    got = topk.top_k(vectors_of(spark, twice), vectors_of(spark, twice).where("vec_id = 20").repartition(3), k=2, shard_rows=2)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and sorted(tuple(r) for r in got.collect()) == brute_top(twice, {20}, 2)
    few = vectors_of(spark, rows[:3])
    assert sorted(tuple(r) for r in topk.top_k(few, few, k=20).collect()) == brute_top(rows[:3], {0, 1, 2}, 20)
    empty = vectors_of(spark, [])
    assert topk.top_k(empty, empty).collect() == [] and topk.top_k(df, empty).collect() == []


def test_threshold_algorithm_stops_early():
    rng = np.random.default_rng(1)
    mat = np.concatenate([rng.integers(-3, 4, (5000, 4)), np.full((5, 4), 50)]).astype(np.int64)
    shard = topk._Shard(np.arange(len(mat)), mat)
    scored = []
    plain = shard.scores
    shard.scores = lambda rows, q: scored.append(len(rows)) or plain(rows, q)
    ids, score = shard.best(np.array([1, 2, 3, 4]), -1, 5)
    assert list(ids) == list(range(5000, 5005)) and set(score) == {500} and sum(scored) < 200


# --- chat

def test_layouts_map_to_turns(spark):
    records = [{"role": "user", "content": "hi"}, {"from": "gpt", "value": "yo"}, {"messages": [{"role": "a", "content": "1"}, {"role": "b", "content": "2"}]},
               {"instruction": "do", "input": "", "output": "done"}, {"instruction": "do", "input": "it", "output": "done"},
               {"message": {"author": {"role": "tool"}, "content": {"parts": ["x", "y"]}}}, {"prompt": "p", "completion": None}, {"odd": 1}]
    rows = [(i, json.dumps(r), "z") for i, r in enumerate(records)] + [(8, None, "z"), (9, "no json", "z"), (10, "[1]", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, record string, mapping string")
    got = sorted((r["conv_id"], r["item"], r["role"], r["text"]) for r in chat.canonical_turns(df, ["conv_id"]).collect() if r["mapping"])
    assert got == [(0, 0, "user", "hi"), (1, 0, "assistant", "yo"), (2, 0, "a", "1"), (2, 1, "b", "2"), (3, 0, "user", "do"), (3, 1, "assistant", "done"),
                   (4, 0, "user", "do\n\nit"), (4, 1, "assistant", "done"), (5, 0, "tool", "xy"), (6, 0, "user", "p"), (6, 1, "assistant", "")]
    assert sum(r["mapping"] is None for r in chat.canonical_turns(df, ["conv_id"]).collect()) == 4


def test_chat_round_trip(spark):
    rng = random.Random(6)
    bits = ["<|im_end|>", "<|im_start|>assistant ok", "<", "|", "\\", "\n", "<\\|", "<\\\\|x", "é𝄞", "assistant\n", "word "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "ro\nle", "a\\nb", "<|x", ""]), "".join(rng.choice(bits) for _ in range(rng.randrange(9))))
            for c in range(40) for t in range(rng.randrange(1, 6))]
    rows += [(50, None, None, None), (50, None, "assistant", None), (None, 1, "user", "x"), (None, 1, "user", "x"), (51, 3, "assistant", "y" * 50_000)]
    rows += [(60, t, "assistant", f"t{t}") for t in range(3000)]
    df = spark.createDataFrame([(*r, "k", "l") for r in rows], "conv_id bigint, turn bigint, role string, text string, item string, piece string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.format_conversations(df).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(),
                   len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got == want
    assert chat.format_conversations(df.limit(0)).collect() == []


# --- archives

def _zip64(data: bytes, index: bytes) -> bytes:
    """An archive whose every size and place is in ZIP64 fields."""
    out, central = io.BytesIO(), b""
    full, half = 0xFFFFFFFF, 0xFFFF
    for name, body in ((warc.DATA.encode(), data), (warc.INDEX.encode(), index)):
        at, crc = out.tell(), zlib.crc32(body)
        extra = struct.pack("<HHQQ", 1, 16, len(body), len(body))
        out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, crc, full, full, len(name), len(extra)) + name + extra + body)
        wide = struct.pack("<HHB", 0x9999, 1, 7) + struct.pack("<HHQQQ", 1, 24, len(body), len(body), at)
        central += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, crc, full, full, len(name), len(wide), 0, 0, 0, 0, full) + name + wide
    start = out.tell()
    out.write(central)
    end = out.tell()
    out.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, 2, 2, len(central), start) + struct.pack("<IIQI", 0x07064B50, 0, end, 1))
    out.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, half, half, full, full, 3) + b"end")
    return out.getvalue()


def test_zip_directories():
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr(zipfile.ZipInfo(warc.DATA), b"payload")
        z.writestr("skipped.txt", b"z" * 100, zipfile.ZIP_DEFLATED)
    for blob in (plain.getvalue(), _zip64(b"payload", b"index")):
        members = {m.name: m for m in warc.stored_members(lambda at, n: blob[at:at + n], len(blob))}
        m = members[warc.DATA]
        assert blob[m.start:m.start + m.size] == b"payload" and "skipped.txt" not in members
    with pytest.raises(ValueError):
        warc.stored_members(lambda at, n: b"x" * n, 100)


def test_archive_round_trip(spark, tmp_path):
    same, long = "é" * 600, "b" * 300_000
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>\r\n\r\n") for i in range(30)] + [(100 + i, None, same) for i in range(40)]
    rows += [(200, "u", None), (201, "u", ""), (202, "u\r\nX: y", long), (203, "u", long), (203, "u", long), (None, "u", same), (None, None, "n" * 2000),
             (300, "u", "c" * 999), (301, "u", "c" * 999), (-5, "u", "d" * 1000), (-9, "u", "d" * 1000)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id bigint, url string, html string, path string, bytes int")
    got = warc.archive_pages(df.repartition(3), str(tmp_path / "zips")).drop("url").collect()
    keep = {}
    for i, _, t in rows:
        if len((t or "").encode()) >= 1000 and i is not None:
            keep[t] = max(keep.get(t, i), i)
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        to = keep.get(t) if keep.get(t) != i else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.archive_pages(df.limit(0), str(tmp_path / "none")).collect() == []
    small = warc.write_packages(warc.with_roles(df), str(tmp_path / "ranges"))
    assert warc.read_packages(small, range_bytes=50).count() == len(rows)


def foreign_package(path):
    """Two archive members of other names, indexes of another form, out of order, with records that no index names."""
    record = {i: warc._record(i, f"http://f/{i}", f"<p>body {i}</p>".encode(), hashlib.sha1(f"<p>body {i}</p>".encode()).hexdigest(), None) for i in range(12)}
    members, lines = {}, {"indexes/a.cdxj": [], "indexes/z.cdx.gz": []}
    for name, ids, index in (("crawl-1.warc.gz", (0, 2, 4, 6, 8), "indexes/a.cdxj"), ("crawl-2.warc.gz", (1, 3, 5, 7), "indexes/z.cdx.gz"),
                             ("crawl-3.warc.gz", (9, 10, 11), "indexes/a.cdxj")):
        body = b""
        for i in ids:
            packed = gzip.compress(record[i], mtime=0)
            if i != 4:  # not in any index
                lines[index].append(f"f,)/{i} 20200101 " + json.dumps({"url": f"http://f/{i}", "filename": name, "offset": len(body), "length": len(packed)}))
            body += packed
        members["archive/" + name] = body
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, rows in lines.items():
            text = "\n".join(["!OpenWayback-CDXJ 1.0", *rows[::-1], ""]).encode()
            z.writestr(zipfile.ZipInfo(name), gzip.compress(text) if name.endswith(".gz") else text)
        for name, body in members.items():
            z.writestr(zipfile.ZipInfo(name), body)
        z.writestr("pages/pages.jsonl", "{}", zipfile.ZIP_DEFLATED)


@pytest.mark.parametrize("ranges", [1, 300, 1 << 20])
def test_foreign_packages(spark, tmp_path, ranges):
    path = str(tmp_path / "foreign.wacz")
    foreign_package(path)
    packages = spark.createDataFrame([(path, os.path.getsize(path))], "path string, bytes bigint")
    got = sorted((r["page_id"], r["payload_bytes"], r["url"], r["record_type"]) for r in warc.read_packages(packages, ranges).collect())
    assert got == [(i, len(f"<p>body {i}</p>"), f"http://f/{i}", "response") for i in range(12) if i != 4]


def test_members_without_an_index_are_refused(spark, tmp_path):
    path = str(tmp_path / "bare.wacz")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(zipfile.ZipInfo("archive/x.warc.gz"), gzip.compress(b"x"))
    packages = spark.createDataFrame([(path, os.path.getsize(path))], "path string, bytes bigint")
    with pytest.raises(Exception, match="no index names"):
        warc.read_packages(packages).collect()


def test_read_back_is_dealt_to_tasks(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    made = warc.write_packages(warc.with_roles(rows.repartition(3)), str(tmp_path / "many"))
    read = warc.read_packages(made, range_bytes=10_000).select("page_id", F.spark_partition_id().alias("task")).collect()
    assert len(read) == 400 and len({r["task"] for r in read}) >= 5


# --- classifiers

def test_languages(spark):
    rng = random.Random(2)
    stems = {"xx": ["alpha", "beta", "gamma", "delta"], "yy": ["über", "straße", "möge", "nicht"], "zz": ["пер", "втор", "трет"]}
    rows = [(i, " ".join(rng.choice(stems[k]) + rng.choice("aeiou") for _ in range(rng.randrange(2, 40))), k, "s")
            for i, k in enumerate(rng.choices(list(stems), [8, 1, 1], k=400))]
    odd = [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "123 !?", "yy", "s"), (1003, "alphaa betao", None, "s"), (None, "übera nichti", "yy", "s"),
           (1003, "alphaa betao", None, "s"), (1004, "alpha beta " * 60_000, "xx", "s")]
    out = {(r["doc_id"], r["held_out"]): r for r in langid.identify_languages(docs_of(spark, rows + odd), crc_of() % 4 == 2).collect()}
    truth = {i: k for i, _, k, _ in rows}
    held = [r for (i, h), r in out.items() if h and i in truth]
    assert len(held) > 50 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    by = {i: r for (i, _), r in out.items()}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "xx", "xx", "yy"]
    assert all(0 <= r["score"] <= 1 for r in out.values()) and all(h == (zlib.crc32(str("" if i is None else i).encode()) % 4 == 2) for i, h in out)
    none = langid.identify_languages(docs_of(spark, [(1, "text", None, "s")]), crc_of() % 4 == 2).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert langid.identify_languages(docs_of(spark, []), crc_of() % 4 == 2).collect() == []


def test_toxicity(spark):
    rng = random.Random(3)
    vocab = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.15
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 80))]
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["horrid", "vile!", "Nastyish"]))
        rows.append((i, " ".join(words), "en", "s"))
        if rng.random() < 0.7:
            labels.append((i, 1, int(bad)))
    rows += [(5000, None, "en", "s"), (5001, "", "en", "s"), (None, "horrid", "en", "s"), (3, "again", "en", "s"), (5002, "vile " * 100_000, "en", "s")]
    truth = {i: t for i, _, t in labels}
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5001, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.rate_documents(docs_of(spark, rows), lab, crc_of() % 5 == 0).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    again = toxicity.rate_documents(docs_of(spark, rows).repartition(5), lab, crc_of() % 5 == 0).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    plain = toxicity.rate_documents(docs_of(spark, rows[:5]), lab.limit(0), crc_of() % 5 == 0).collect()
    assert {r["score"] for r in plain} == {0.0}
    assert toxicity.rate_documents(docs_of(spark, []), lab, crc_of() % 5 == 0).collect() == []


def test_corrected_risk_never_turns_negative():
    rng = np.random.default_rng(0)
    blob = lambda: np.unique(rng.integers(0, toxicity.BINS, 50)).astype(np.int32).tobytes()
    w, b, value = toxicity.fit([blob() for _ in range(40)], [blob() for _ in range(200)], 0.2)
    assert np.isfinite(w).all() and np.isfinite(b) and np.isfinite(value).all()


# --- decontamination

def test_decontamination(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(8)]
    items += [(20, "too short item"), (21, None), (None, items[0][1]), (22, ""), (23, " ".join(word() for _ in range(9)))]
    clean = lambda n: [word() for _ in range(n)]

    def replaced(text, every):
        return [("zzz" if i % every == every - 1 else w) for i, w in enumerate(text.split())]

    cases = {1: (items[0][1].split(), {0}), 2: (replaced(items[1][1], 5), {1}), 3: (replaced(items[2][1], 4), {2}), 4: (items[3][1].upper().split(), {3}),
             5: (items[4][1].split()[5:22], {4}), 6: (items[5][1].split()[5:13], set()), 7: ([], set()), 8: (items[-1][1].split(), {23}),
             9: (items[6][1].replace(" ", ", ").split(), {6}), 10: (items[0][1].split() + ["mid"] + items[7][1].split(), {0, 7})}
    rows = [(k, " ".join(clean(40) + w + clean(40)), "en", "s") for k, (w, _) in cases.items()]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, items[0][1], "en", "s"), (102, items[0][1], "en", "s"), (None, items[0][1], "en", "s"),
             (103, " ".join(clean(50_000) + items[1][1].split()), "en", "s"), (104, "too short item", "en", "s")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, overlaps int")
    for size in (4 << 20, 300):
        got = decontam.with_overlaps(docs_of(spark, rows), bench, slice_bytes=size)
        assert got.columns == [c.split()[0] for c in DOCS.split(", ")] + ["overlaps"]
        found = [(r["doc_id"], frozenset(x["item_id"] for x in r["overlaps"])) for r in got.collect()]
        want = [(k, frozenset(s)) for k, (_, s) in cases.items()] + [(i, frozenset(s)) for i, s in (
            (100, ()), (101, ()), (102, {0}), (102, {0}), (None, {0}), (103, {1}), (104, ()))]
        assert sorted(found, key=str) == sorted(want, key=str)
    exact = [r for r in decontam.contaminated(docs_of(spark, rows), bench).collect() if r["doc_id"] == 1]
    assert [(r["matched"], r["aligned"], r["start"]) for r in exact] == [(30, 30, 40)]
    assert decontam.contaminated(docs_of(spark, []), bench).collect() == [] == decontam.contaminated(docs_of(spark, rows), bench.limit(0)).collect()


def brute_passage(same):
    n = len(same)
    return any(5 * sum(same[i:j]) >= 4 * (j - i) for i in range(n) for j in range(i + 13, n + 1))


def test_decontamination_keeps_columns_of_any_name(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(1, passage), (2, " ".join(f"v{i}" for i in range(40)))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"Some {passage.upper()} more", "a", "b", "c", "d"), (2, None, "a", "b", "c", "d")] + [(3, passage, "x", "y", "z", None)] * 3,
                                 "doc_id bigint, text string, _decontam_text string, _decontam_same string, `_Decontam_hits` string, _n string")
    for size in (1 << 20, 100):
        got = decontam.with_overlaps(docs, bench, slice_bytes=size)
        assert got.columns == [*docs.columns, "overlaps"]
        rows = got.collect()
        assert sorted(map(str, [tuple(r)[:-1] for r in rows])) == sorted(map(str, map(tuple, docs.collect())))
        assert sorted((r["doc_id"], [x["item_id"] for x in r["overlaps"]]) for r in rows) == [(1, [1]), (2, [])] + [(3, [1])] * 3


def test_decontamination_of_partial_passages_with_substitutions():
    item = [f"w{i}x" for i in range(60)]
    swapped = lambda n, at: ["zzz" if i in at else w for i, w in enumerate(item[:n])]
    seeds = decontam.Seeds([7], [" ".join(item)])

    def found(words):
        data = " ".join(["q"] * 15 + words + ["q"] * 15).encode()
        return seeds.overlaps(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]

    for words, matched, aligned in ((swapped(20, {4, 17}), 18, 20), (swapped(30, set(range(4, 30, 5))), 24, 29), (swapped(16, {13}), 15, 16)):
        assert found(words) == [{"item_id": 7, "matched": matched, "aligned": aligned, "start": 15}]
    assert found(swapped(30, set(range(2, 30, 3)))) == [] == found(item[:10])
    rng = random.Random(21)
    for _ in range(300):
        n = rng.randrange(11, 36)
        same = [rng.random() < 0.8 for _ in range(n)]
        hits = found([w if s else "zzz" for w, s in zip(item, same)])
        assert bool(hits) == brute_passage(same + [False] * (60 - n)), same


# --- pipeline

def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    docs_of(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.collect() == [] and set(out.columns) >= {"doc_id", "text", "size", "taken"}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(13)
    vocab = [f"plain{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bench = [(i, text(25)) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        t = text(60)
        rows.append((i, t + (" horrid vile nastyish horrid" * 3 if bad else ""), "en", rng.choice(["a", "b", None])))
        labels.append((i, 1, int(bad)))
    base = text(120)
    rows += [(1000 + i, base + f" end{i}", "en", "a") for i in range(30)] + [(1000, base + " end0", "en", "a"), (None, base, "en", "b")]
    rows += [(2000 + i, text(30) + " " + bench[i][1] + " " + text(30), "en", "b") for i in range(5)]
    rows += [(3000, text(40) + " password: abcdefghijklmnop " + text(5), "en", "b"), (3001, None, None, None), (3002, "", None, None)]
    folder = str(tmp_path)
    odd = ("__mark", "_Mark", "__row", "_row_number", "_overlaps", "_toxicity", "_toxicity_text", "_secret_id", "_secret_mark", "__spans", "_mix_id", "_src", "taken")
    docs_of(spark, rows).drop("size", "target").withColumns({c: F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))) for c in odd}).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}.parquet"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "mixing":
            assert docs.columns == columns
        kept = [c for c in odd if c != "taken" or name != "mixing"]
        for c in kept:
            assert docs.where(F.col(c) != F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0)))).isEmpty(), (name, c)
        after[name] = docs.select("doc_id", "text", "n_chars").collect()
    ids = {n: [r["doc_id"] for r in v] for n, v in after.items()}
    toxic = {i for i, _, t in labels if t}
    assert not toxic & set(ids["toxicity"]) and len(ids["toxicity"]) >= len(rows) - len(toxic) - 3
    family = [r for r in after["ngram_jaccard"] if r["text"] and r["text"].startswith(base)]
    assert len(family) == 1 and len(ids["ngram_jaccard"]) == len(ids["toxicity"]) - 31
    assert set(ids["ngram_jaccard"]) - set(ids["decontamination"]) == {2000, 2001, 2002, 2003, 2004}
    hidden = {r["doc_id"]: r for r in after["secrets"]}[3000]
    assert "[SECRET]" in hidden["text"] and "abcdefghijklmnop" not in hidden["text"] and hidden["n_chars"] == len(hidden["text"])
    assert sorted(ids["secrets"], key=str) == sorted(ids["decontamination"], key=str)
    taken = {r["doc_id"]: r["taken"] for r in docs.collect()}
    assert taken and min(taken.values()) > 0 and corpus_pipeline.ORACLE_SQL is None
