"""Secret scans with corpus-wide ownership frequency, native throughout.

Each text is scanned for credentials in known forms and for other tokens that could be one. The hash of every candidate
is then counted over the corpus by distinct repositories and owners: what many owners or many repositories hold is a
copied example; what one owner alone holds in few repositories looks live. Live-looking tokens without a known form are added to the spans found by form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.session import stored

#: The forms, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A token of no known form: long, of one word, with letters and digits and at least so many different characters.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = 10
#: Owners, and repositories of whatever owners, from which a value counts as copied.
COPIED = 3
REPEATED = 10
MASK = "[SECRET]"


def _found(text: Column, pattern: str, kind: str, order: int, accept, value) -> Column:
    """Spans of a pattern's matches: array of (start, ord, end, kind, value), from the pieces between the matches."""
    pieces = F.split(text, pattern, -1)

    def spans(p: Column) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,said:string>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            first = acc["at"] + F.length(x["p"])
            end = first + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("start"), end.alias("end"), x["m"].alias("said")))).alias("out"))

        pairs = F.zip_with(F.slice(p, 1, F.size(p) - 1), matches, lambda a, b: F.struct(a.alias("p"), b.alias("m")))
        placed = F.aggregate(pairs, start, step, lambda acc: acc["out"])
        kept = F.filter(placed, lambda x: accept(x["said"]))
        return F.transform(kept, lambda x: F.struct(x["start"], F.lit(order).alias("ord"), x["end"], F.lit(kind).alias("kind"), value(x["said"]).alias("value")))

    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,value:string>>")
    return F.transform(F.array(pieces), lambda p: F.when(F.size(p) > 1, spans(p)).otherwise(none))[0]


def candidates(text: Column) -> Column:
    """All spans of a text, base forms first in order of start, then kind; tokens that touch none of them last."""
    value = lambda said: F.regexp_extract(said, ASSIGN, 2)
    same, always = (lambda said: said), (lambda said: F.lit(True))
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,value:string>>")
    assign = F.when(F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), _found(text, ASSIGN, "assign", 0, lambda said: F.length(value(said)) >= 6, value)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), _found(text, ACCESS, "access", 1, always, same)).otherwise(none)
    base = F.array_sort(F.concat(assign, access, _found(text, HEX, "hex", 2, always, same)))
    varied = lambda said: said.rlike("[0-9]") & said.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(said, ""))) >= KINDS)
    tokens = _found(text, TOKEN, "token", 3, varied, same)

    def apart(b: Column) -> Column:
        return F.concat(b, F.filter(tokens, lambda t: ~F.exists(b, lambda x: (x["start"] < t["end"]) & (t["start"] < x["end"]))))

    return F.transform(F.array(base), apart)[0]


def ownership(held: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners) of rows (hash, repo, owner): distinct counts by two partial aggregations, no group whole."""
    repos = held.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = repos.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def _judged(facts: DataFrame) -> DataFrame:
    """(row, live, n_live, n_copied, judged) of each row of facts (row, repo, owner, c) that has a candidate."""
    each = facts.where(F.size("c") > 0).select("row", "repo", "owner", F.explode("c").alias("x")).select("row", "repo", "owner", "x", F.col("x.hash").alias("hash"))
    known = ownership(each.select("hash", "repo", "owner"))
    verdict = F.when((F.col("n_owners") >= COPIED) | (F.col("n_repos") >= REPEATED), "copied").when(F.col("n_owners") == 1, "live").otherwise("unsure")
    judged = each.select("row", "x", "hash").join(known, "hash").withColumn("verdict", verdict)
    span = F.struct(F.col("x.start").alias("start"), F.col("x.ord").alias("ord"), F.col("x.end").alias("end"), F.col("x.kind").alias("kind"))
    facts_of = F.struct("x.start", "x.ord", "x.end", "x.kind", "n_repos", "n_owners", "verdict")
    live, copied = F.col("verdict") == "live", F.col("verdict") == "copied"
    return judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(live & (F.col("x.ord") == 3), span))).alias("live"), F.count_if(live).alias("n_live"), F.count_if(copied).alias("n_copied"), F.array_sort(F.collect_list(facts_of)).alias("judged")
    )


def _facts(docs: DataFrame, text_col: str, repo_col: str, owner_col: str, *kept: Column) -> DataFrame:
    """(row, .. kept, repo, owner, c), stored: each text scanned once, its candidates with hashes for values."""
    found = docs.select(*kept, F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).alias("owner"), candidates(F.coalesce(F.col(text_col), F.lit(""))).alias("c"))
    hashed = F.transform("c", lambda x: F.struct(x["start"], x["ord"], x["end"], x["kind"], F.md5(x["value"]).alias("hash")))
    return stored(found.withColumn("c", hashed).withColumn("row", F.monotonically_increasing_id()), "secrets")


def _base() -> Column:
    return F.transform(F.filter("c", lambda x: x["ord"] < 3), lambda x: F.struct(x["start"], x["ord"], x["end"], x["kind"]))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """One row per row of docs: (id, text_md5, base, live, n_live, n_copied, judged).

    base: spans found by form; live: tokens of no known form that look live; both (start, ord, end, kind) in order.
    judged: every candidate as (start, ord, end, kind, n_repos, n_owners, verdict), in order. verdict: copied (COPIED
    owners or REPEATED repositories at least), live (one owner, fewer repositories) or unsure. n_live and n_copied count
    the candidates of either kind by verdict. A null text is empty, a null owner or repository is one of its own. A repository
    belongs to its owner: the same name under two owners is two. Rows that repeat an id are scanned each by itself.
    """
    facts = _facts(docs, text_col, repo_col, owner_col, F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_md5"))
    rows = facts.select("row", "id", "text_md5", _base().alias("base"), F.size("c").alias("some"))
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    none_judged = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,n_repos:bigint,n_owners:bigint,verdict:string>>")
    zero = F.lit(0).cast("long")
    plain = rows.where("some = 0").select("id", "text_md5", "base", F.col("base").alias("live"), zero.alias("n_live"), zero.alias("n_copied"), none_judged.alias("judged"))
    met = rows.where("some > 0").join(_judged(facts), "row", "left")
    return plain.unionByName(met.select("id", "text_md5", "base", F.coalesce("live", none).alias("live"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"), F.coalesce("judged", none_judged).alias("judged")))


def said(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span (in order of start; they may overlap) replaced by MASK."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(MASK))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def redacted(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """docs with the spans of known form and the live-looking tokens masked, and size_col counted anew where that is.

    Copied examples of no known form stay. Each text is scanned once and kept beside its spans; only rows with a span
    move to meet their verdicts. Null texts stay null; rows that repeat an id, and columns of any name, are no matter.
    """
    facts = _facts(docs, text_col, repo_col, owner_col, F.struct(*docs.columns).alias("doc"))
    met = facts.where(F.size("c") > 0).select("row", "doc", _base().alias("base")).join(_judged(facts).select("row", "live"), "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("live", F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>"))))
    met = met.select("doc", spans.alias("spans")).withColumn("new", F.when(F.size("spans") > 0, masked(F.col(f"doc.{text_col}"), F.col("spans"))))
    changed = {text_col: F.coalesce("new", f"doc.{text_col}"), size_col: F.coalesce(F.length("new").cast(docs.schema[size_col].dataType), f"doc.{size_col}")}
    made = met.select(*(changed.get(c, F.col(f"doc.{c}")).alias(c) for c in docs.columns))
    return made.unionByName(facts.where(F.size("c") == 0).select("doc.*"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's spans; its repository is the document, its owner the source.

    verdicts: of each candidate in order its verdict, repositories and owners.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned(docs).select(
        F.col("id").alias("doc_id"), of("assign"), of("access"), of("hex"), F.sha2(said(F.col("base")), 256).alias("base_sha256"), said(F.array_sort(F.concat("base", "live"))).alias("spans"), "n_live", "n_copied",
        F.array_join(F.transform("judged", lambda x: F.concat_ws(":", x["verdict"], x["n_repos"], x["n_owners"])), ",").alias("verdicts"),
    )


def _sql_kind(kind: str, order: int, pattern: str, group: int, test: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT row, '{kind}' AS kind, {order} AS ord, v,
        (coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::INT AS start, length(said) AS size
      FROM (SELECT row, p, m, unnest(m) AS said, unnest(g) AS v, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT row, string_split_regex(s, '{p}') AS p, regexp_extract_all(s, '{p}', 0) AS m, regexp_extract_all(s, '{p}', {group}) AS g FROM t) WHERE len(m) > 0)
      WHERE {test}"""


ORACLE_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, source AS owner, coalesce(text, '') AS s FROM documents),
base AS ({_sql_kind("assign", 0, ASSIGN, 2, "length(v) >= 6")} UNION ALL {_sql_kind("access", 1, ACCESS, 0, "true")} UNION ALL {_sql_kind("hex", 2, HEX, 0, "true")}),
tokens AS ({_sql_kind("token", 3, TOKEN, 0, f"regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= {KINDS}")}),
apart AS (SELECT k.* FROM tokens k ANTI JOIN base b ON b.row = k.row AND b.start < k.start + k.size AND k.start < b.start + b.size),
every AS (SELECT * FROM base UNION ALL SELECT * FROM apart),
held AS (SELECT md5(v) AS h, coalesce(owner, chr(1)) AS owner, count(DISTINCT coalesce(doc_id, -1)) AS repos FROM every JOIN t USING (row) GROUP BY 1, 2),
owners AS (SELECT h, count(*) AS n_owners, sum(repos) AS n_repos FROM held GROUP BY 1),
judged AS (SELECT e.*, n_repos::BIGINT AS n_repos, n_owners, CASE WHEN n_owners >= {COPIED} OR n_repos >= {REPEATED} THEN 'copied' WHEN n_owners = 1 THEN 'live' ELSE 'unsure' END AS verdict FROM every e JOIN owners ON h = md5(v)),
per AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord) FILTER (ord < 3), '') AS b,
  coalesce(string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord) FILTER (ord < 3 OR verdict = 'live'), '') AS spans,
  count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'copied') AS n_copied, string_agg(verdict || ':' || n_repos || ':' || n_owners, ',' ORDER BY start, ord) AS verdicts FROM judged GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(verdicts, '') AS verdicts FROM t LEFT JOIN per USING (row)
"""
