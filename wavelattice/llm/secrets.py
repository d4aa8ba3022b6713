"""Secret scan with multipart credential linking, in DataFrame operations only.

Certain findings are assignments to secret-like names, access key ids and long hex strings. Weak candidates (other key
ids, high-entropy strings, endpoints) mean nothing alone; they are reported only where complementary parts occur together.
The parts of a text are intervals; each weak part is joined with the nearest identifier, secret and endpoint before and
after it that lie within its scope (a distance in code points). The nearest ones decide, so the interval join is two
running maxima in each direction over the parts in order, and no pair is built.

Places come from the pieces between the matches: a match starts after the pieces and matches before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wavelattice.llm.common import settled, table

SCOPE = 256
#: Base kinds in report order: pattern, group whose length counts, least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Weak kinds: maximal runs that are kept when they look like one.
IDENT = r"(?:ASIA|AROA|AIDA|AGPA)[A-Z0-9]{12,}"
SECRET = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"https?://[A-Za-z0-9._~:/?#@%&=+-]{4,}"
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
_SPAN = "array<struct<s:int,e:int>>"
_BLOCK = 512


def _running(lengths: Column) -> Column:
    """Sums of ``lengths`` before each element. Blocks keep the work of appending near linear."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))

    def sums(xs: Column, first: Column) -> Column:
        state = F.aggregate(xs, F.struct(first.alias("t"), F.array().cast("array<int>").alias("a")),
                            lambda acc, x: F.struct((acc["t"] + x).cast("int").alias("t"),
                                                    F.concat(acc["a"], F.array(acc["t"])).alias("a")))
        return state["a"]

    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, sums(totals, F.lit(0)), sums))


def _with_spans(df: DataFrame, text: str, kinds: dict) -> DataFrame:
    """A column of spans per kind: the leftmost non-overlapping matches, in code points.

    ``kinds`` gives pattern and a condition on the match (or None). Each step is a projection of its own, so that the
    pattern runs over a text once and only texts with matches are split.
    """
    rest = [c for c in df.columns if c not in kinds]
    df = df.select(*rest, *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"_m_{k}") for k, (p, _) in kinds.items()])
    some = {k: F.size(f"_m_{k}") > 0 for k in kinds}
    df = df.select(*[c for c in rest if c != text], *[f"_m_{k}" for k in kinds], *[
        F.when(some[k], F.transform(F.split(text, p, -1), lambda x: F.length(x))).alias(f"_p_{k}") for k, (p, _) in kinds.items()])
    rest = [c for c in rest if c != text]
    sizes = {k: F.zip_with(F.slice(f"_p_{k}", 1, F.size(f"_m_{k}")), f"_m_{k}", lambda p, m: p + F.length(m)) for k in kinds}
    df = df.select(*rest, *[f"_m_{k}" for k in kinds], *[f"_p_{k}" for k in kinds], *[
        F.when(some[k], _running(sizes[k])).alias(f"_b_{k}") for k in kinds])

    def spans(kind: str, keep) -> Column:
        starts = F.zip_with(f"_b_{kind}", F.slice(f"_p_{kind}", 1, F.size(f"_m_{kind}")), lambda b, p: b + p)
        out = F.zip_with(starts, f"_m_{kind}", lambda s, m: F.struct(s.alias("s"), (s + F.length(m)).alias("e"), m.alias("m")))
        out = F.filter(out, lambda x: keep(x["m"])) if keep is not None else out
        out = F.transform(out, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        return F.when(some[kind], out).otherwise(F.array().cast(_SPAN)).alias(kind)

    return df.select(*rest, *[spans(k, keep) for k, (_, keep) in kinds.items()])


def _mixed(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key, _mark`` (a hash of the text) and an array of spans per kind."""
    src = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    src = src.withColumn("_mark", F.xxhash64("_t"))
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12
    return _with_spans(src, "_t", {
        "assign": ("(?=[pPsStTaA])" + ASSIGN, long_value), "access": (ACCESS, None), "hex": ("(?<![0-9a-f])" + HEX, None),
        "ident": (IDENT, None), "secret": ("(?<![A-Za-z0-9+/])" + SECRET, _mixed), "endpoint": (ENDPOINT, None)})


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """``_k, _m, _weak``: the weak spans to report, for texts with an identifier and a weak part."""
    has = lambda *kinds: F.greatest(*[F.size(k) for k in kinds]) > 0
    rows = found.where(has("access", "ident") & has("ident", "secret", "endpoint")).dropDuplicates(["_key", "_mark"])
    tagged = lambda k: F.transform(F.col(k), lambda x: F.struct(
        F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    parts = F.concat(*map(tagged, KINDS))
    p = rows.select("_key", "_mark", F.explode(parts).alias("p")).select("_key", "_mark", "p.*")
    order = Window.partitionBy("_key", "_mark")
    # ends before and starts after every part, by role; ties in the start are ordered so that both directions see all
    back = order.orderBy("s", "e", "k").rowsBetween(Window.unboundedPreceding, -1)
    ahead = order.orderBy("s", "e", "k").rowsBetween(1, Window.unboundedFollowing)
    roles = {"id": F.col("k").isin("access", "ident"), "key": F.col("k").isin("secret", "assign"), "at": F.col("k") == "endpoint",
             "base": F.col("k").isin("assign", "access", "hex")}
    for name, is_role in roles.items():
        p = p.withColumn(f"_{name}_b", F.max(F.when(is_role, F.col("e"))).over(back))
        p = p.withColumn(f"_{name}_a", F.min(F.when(is_role, F.col("s"))).over(ahead))

    def near(name: str) -> Column:
        return (F.coalesce(F.col("s") - F.col(f"_{name}_b") <= scope, F.lit(False))
                | F.coalesce(F.col(f"_{name}_a") - F.col("e") <= scope, F.lit(False)))

    covered = F.coalesce(F.col("_base_b") > F.col("s"), F.lit(False)) | F.coalesce(F.col("_base_a") < F.col("e"), F.lit(False))
    told = ((F.col("k") == "ident") & near("key")) | ((F.col("k") == "secret") & near("id")) | (
        (F.col("k") == "endpoint") & near("id") & near("key"))
    return p.where(F.col("k").isin("ident", "secret", "endpoint") & ~covered & told).groupBy(
        F.col("_key").alias("_k"), F.col("_mark").alias("_m")).agg(F.collect_list(F.struct("k", "s", "e")).alias("_weak"))


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``key, base, spans`` for every row: arrays of ``kind, start, end`` by start, then kind (certain ones, and all).

    Starts and ends are code points, ends exclusive. Weak parts: an identifier is reported near a secret or assignment, a
    secret of any length near an identifier, an endpoint near both, within ``scope`` code points; parts inside a certain finding are
    not reported again. Null texts are empty. Rows with equal key and text get equal results; rows that share a key
    keep apart by their text. An empty table gives an empty result. Other columns are not read.
    """
    found = settled(_found(docs, key, text))
    weak = _linked(found, scope)
    ranked = lambda k, rank: F.transform(F.col(k), lambda x: F.struct(
        x["s"].alias("s"), F.lit(rank).alias("r"), F.lit(k).alias("k"), x["e"].alias("e")))
    base = F.concat(*[ranked(k, i) for i, k in enumerate(("assign", "access", "hex"))])
    out = found.join(weak, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_mark") == F.col("_m")), "left")
    more = F.transform(F.coalesce("_weak", F.array().cast("array<struct<k:string,s:int,e:int>>")), lambda x: F.struct(
        x["s"].alias("s"), (F.array_position(F.array(*map(F.lit, KINDS)), x["k"]) - 1).cast("int").alias("r"),
        x["k"].alias("k"), x["e"].alias("e")))
    plain = lambda a: F.transform(F.array_sort(a), lambda x: F.struct(
        x["k"].alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    return out.select(F.col("_key").alias(key), plain(base).alias("base"), plain(F.concat(base, more)).alias("spans"), "_mark")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every maximal union of spans replaced by ``mark``."""
    merged = F.aggregate(
        spans, F.array().cast(_SPAN),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["start"]), F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["end"]).alias("e"))),
        )).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("s"), x["end"].alias("e"))))))
    starts = F.concat(F.array(F.lit(0)), F.transform(merged, lambda x: x["e"]))
    ends = F.concat(F.transform(merged, lambda x: x["s"]), F.array(F.length(text)))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a))
    return F.when(F.size(spans) > 0, F.array_join(kept, mark)).otherwise(text)


def query(spark, sf: str) -> DataFrame:
    out = secret_spans(table(spark, sf, "documents"))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return out.select("doc_id", n("assign"), n("access"), n("hex"),
                      F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_kind(kind: str, pattern: str, keep: str = "true") -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT rn, '{kind}' AS k, s + plen AS s, s + plen + mlen AS e FROM (
  SELECT rn, i, m, length(p) AS plen, length(m) AS mlen,
    coalesce(sum(length(p) + length(m)) OVER (PARTITION BY rn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s
  FROM (SELECT rn, unnest(generate_series(1, len(ms))) AS i, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p FROM (
    SELECT rn, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS ps FROM d WHERE regexp_matches(t, '{p}'))))
 WHERE {keep}"""


_RE2_ASSIGN = ASSIGN.replace("(?i:(password|passwd|secret|token|api_?key))", "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|"
                             "[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])")
_NEAR = {n: f"(coalesce(s - {n}_b <= {SCOPE}, false) OR coalesce({n}_a - e <= {SCOPE}, false))" for n in ("id", "key", "at")}
_MIXED = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')"
_ROLES = {"id": "k IN ('access', 'ident')", "key": "k IN ('secret', 'assign')", "at": "k = 'endpoint'",
          "base": "k IN ('assign', 'access', 'hex')"}
_RANK = "list_position(['assign', 'access', 'hex', 'ident', 'secret', 'endpoint'], k)"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
p AS ({_sql_kind('assign', _RE2_ASSIGN, "length(regexp_extract(m, '" + _RE2_ASSIGN.replace("'", "''") + "', 2)) >= 12")}
  UNION ALL {_sql_kind('access', ACCESS)} UNION ALL {_sql_kind('hex', HEX)} UNION ALL {_sql_kind('ident', IDENT)}
  UNION ALL {_sql_kind('secret', SECRET, _MIXED)} UNION ALL {_sql_kind('endpoint', ENDPOINT)}),
w AS (SELECT *, {', '.join(
    f"max(e) FILTER ({r}) OVER (PARTITION BY rn ORDER BY s, e, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS {n}_b, "
    f"min(s) FILTER ({r}) OVER (PARTITION BY rn ORDER BY s, e, k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS {n}_a"
    for n, r in _ROLES.items())} FROM p),
a AS (SELECT rn, k, s, e FROM p WHERE k IN ('assign', 'access', 'hex')
  UNION ALL SELECT rn, k, s, e FROM w WHERE k IN ('ident', 'secret', 'endpoint')
    AND NOT coalesce(base_b > s, false) AND NOT coalesce(base_a < e, false)
    AND ((k = 'ident' AND {_NEAR['key']}) OR (k = 'secret' AND {_NEAR['id']}) OR (k = 'endpoint' AND {_NEAR['id']} AND {_NEAR['key']}))),
g AS (SELECT rn, count(*) FILTER (k = 'assign') AS n_assign, count(*) FILTER (k = 'access') AS n_access, count(*) FILTER (k = 'hex') AS n_hex,
  string_agg(k || ':' || s || ':' || e, ',' ORDER BY s, {_RANK}) FILTER (k IN ('assign', 'access', 'hex')) AS base,
  string_agg(k || ':' || s || ':' || e, ',' ORDER BY s, {_RANK}) AS spans FROM a GROUP BY rn)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rn)
"""
