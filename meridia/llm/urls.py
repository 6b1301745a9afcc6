"""URL filters: host and path rules, and a path-template tree judged by the rules' own verdicts.

A host's paths form a tree, level by level of their segments, to ``DEPTH`` segments; what lies deeper is one segment
``**``. A segment is generalised into the wildcard ``*`` if it is variable by its form (a number, or long with digits) or
rare at its node: on under ``LEAST`` pages or under ``SHARE`` of the node's pages. Literals that pages really share stay, on
however busy a host. What the leaves spell is a template.

Sister templates, which differ in one literal alone, are merged where they are statistically alike (of the literals by which
a template has sisters, the one with the most of them counts, the deepest of equals): the shares of
pages that end in a number, in a file name and in a slash, and those that are blocked among the labelled ones, must each
pass a two-proportion test of the template against its sisters.

Pages on which a rule decides are labelled. A template's purity is the share of blocked pages among its labelled ones;
pages without a label count against it, ``UNLABELLED`` of a page each, and ``PRIOR`` pages are added at the host's own purity,
which is smoothed alike by that of all hosts. A template is rejected if its purity reaches ``PURITY``. So pages without
a rule are blocked where they share a template with pages of which nearly all are blocked, or stand on a host of such
pages in a template that is too thin to tell.

Scale. Pages are summed by (host, segments) with map-side combining before anything else. A level counts (node, segment)
pairs, numbers as one, and sends back the literals that stay, at most ``1 / SHARE`` for each node; they are broadcast while
they are few, else joined by shuffle, where adaptive execution splits a host with many paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, table

#: (host, path, verdict); a rule fits its host and all subdomains, if the path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEPTH = 8
LEAST, SHARE = 3, 0.01
PURITY = 0.8
PRIOR = 4
UNLABELLED = 0.25
#: Two shares are alike if they differ by under so many standard errors.
ALIKE = 1.96
BROADCAST_ROWS = 100_000
COUNTS = ("pages", "labelled", "blocked", "numbers", "files", "slashes")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://`` and for null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule (host and path) and verdict of the longest rule that fits, the earlier one of equal length; null without."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _small(rows: DataFrame) -> DataFrame:
    rows = checkpointed(rows)
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def variable(segment: Column) -> Column:
    """A number, with or without an ending; long, with a digit; or what looks like a wildcard itself."""
    return segment.rlike(r"^[0-9]+(\.[A-Za-z]+)?$") | (segment.rlike("[0-9]") & (F.char_length(segment) >= 8)) | segment.isin("", "*", "**")


def templates(sums: DataFrame) -> DataFrame:
    """``sums`` (host, parts, and counts) -> with template: literals and wildcards, level by level."""
    levels = min(DEPTH, sums.agg(F.max(F.size("parts"))).first()[0] or 0)
    sums = sums.withColumn("template", F.lit(""))
    for k in range(levels):
        part = F.get("parts", F.lit(k))
        sums = sums.withColumn("segment", F.when(variable(part), "*").otherwise(part))
        branches = checkpointed(sums.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(F.sum("pages").alias("n")))
        nodes = branches.groupBy("host", "template").agg(F.sum("n").alias("of"))
        stay = branches.join(nodes, ["host", "template"]).where((F.col("segment") != "*") & (F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("of")))
        sums = sums.join(_small(stay.select("host", "template", "segment", F.lit(True).alias("stays"))), ["host", "template", "segment"], "left")
        spelled = F.when(F.col("segment").isNull(), "").when(F.col("stays"), F.concat(F.lit("/"), "segment")).otherwise("/*")
        sums = checkpointed(sums.withColumn("template", F.concat("template", spelled)).drop("segment", "stays"))
    return sums.withColumn("template", F.concat("template", F.when(F.size("parts") > DEPTH, "/**").otherwise("")))


def differ(a: Column, n: Column, b: Column, m: Column) -> Column:
    """Whether a of n and b of m are other shares than chance explains; not, if one of them is of nothing."""
    a, n, b, m = (x.cast("double") for x in (a, n, b, m))
    both = (a + b) / F.when((n > 0) & (m > 0), n + m)
    return F.coalesce(F.abs(a / F.when(n > 0, n) - b / F.when(m > 0, m)) > ALIKE * F.sqrt(both * (1 - both) * (1 / F.when(n > 0, n) + 1 / F.when(m > 0, m))), F.lit(False))


def purity(blocked: Column, labelled: Column, pages: Column, prior: Column) -> Column:
    return (blocked + PRIOR * prior) / (labelled + UNLABELLED * (pages - labelled) + PRIOR)


def verdicts(stats: DataFrame) -> DataFrame:
    """``stats`` (host, template, and counts), a row for each template -> host, template, rejected."""
    parts = F.split("template", "/")
    literal = F.filter(F.transform(parts, lambda x, i: F.when(~x.isin("", "*", "**"), i)), lambda i: i.isNotNull())
    each = stats.select("host", "template", F.explode(literal).alias("at")).withColumn("family", F.array_join(F.transform(parts, lambda x, i: F.when(i == F.col("at"), "?").otherwise(x)), "/"))
    best = each.join(each.groupBy("host", "family").agg(F.count("*").alias("n")), ["host", "family"]).groupBy("host", "template").agg(F.max(F.struct("n", "at", "family")).alias("best"))
    stats = checkpointed(stats.join(best, ["host", "template"], "left").withColumn("family", F.coalesce("best.family", "template")).drop("best"))
    family = stats.groupBy("host", "family").agg(*[F.sum(c).alias(f"f_{c}") for c in COUNTS], F.count("*").alias("sisters"))
    x = stats.join(family, ["host", "family"])
    others = {c: F.col(f"f_{c}") - F.col(c) for c in COUNTS}
    unlike = differ(F.col("blocked"), F.col("labelled"), others["blocked"], others["labelled"])
    for c in ("numbers", "files", "slashes"):
        unlike = unlike | differ(F.col(c), F.col("pages"), others[c], others["pages"])
    x = x.withColumn("merges", (F.col("sisters") > 1) & ~unlike)
    merged = x.where("merges").groupBy("host", "family").agg(*[F.sum(c).alias(f"m_{c}") for c in COUNTS[:3]])
    own = {c: F.when(F.col("merges"), F.col(f"m_{c}")).otherwise(F.col(c)) for c in COUNTS[:3]}
    x = x.join(merged, ["host", "family"], "left").select("host", "template", *[own[c].alias(c) for c in COUNTS[:3]])
    hosts = stats.groupBy("host").agg(*[F.sum(c).alias(f"h_{c}") for c in COUNTS[:3]])
    whole = hosts.agg(*[F.sum(f"h_{c}").alias(f"w_{c}") for c in COUNTS[:3]])  # one row
    base = (F.col("w_blocked") + 1) / (F.col("w_labelled") + UNLABELLED * (F.col("w_pages") - F.col("w_labelled")) + 2)
    hosts = hosts.crossJoin(F.broadcast(whole)).select("host", purity(F.col("h_blocked"), F.col("h_labelled"), F.col("h_pages"), base).alias("prior"))
    return x.join(hosts, "host").select("host", "template", (purity(F.col("blocked"), F.col("labelled"), F.col("pages"), F.col("prior")) >= PURITY).alias("rejected"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, template, verdict): a row for each row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, like an url without either; such pages have a
    template like any other, and as no rule fits them, it is allowed. Equal rows are judged alike, and each counts. No
    rows give no rows. Only the two named columns are read.
    """
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"))
    host, path = split_url(F.col("url"))
    base = base.select("id", host.alias("host"), path.alias("path"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    # no more than what is looked at: one segment beyond DEPTH says that there are some
    parts = F.slice(F.filter(F.split("path", "/"), lambda x: x != ""), 1, DEPTH + 1)
    base = base.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("parts", parts)
    last = F.get("parts", F.size("parts") - 1)
    flags = {"numbers": last.rlike("^[0-9]"), "files": last.rlike(r"\.[A-Za-z]+$"), "slashes": F.col("path").endswith("/")}
    counts = [F.count("*").alias("pages"), F.count("ruled").alias("labelled"), F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"), *[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()]]
    spelled = templates(checkpointed(base.groupBy("host", "parts").agg(*counts)))
    judged = verdicts(checkpointed(spelled.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in COUNTS])))
    known = spelled.join(_small(judged), ["host", "template"]).select("host", "parts", F.concat("host", "template").alias("template"), "rejected")
    done = base.join(known, ["host", "parts"])
    return done.select("id", "host", "path", "rule", "template", F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"))


def op10_urls(spark, sf_dir: str) -> DataFrame:
    """Contract of op10 over all of ``pages``."""
    return judge(table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _levels() -> str:
    """The tree, level by level, in SQL."""
    out = []
    for k in range(DEPTH):
        out.append(f"""g{k} AS MATERIALIZED (SELECT *, CASE WHEN len(parts) <= {k} THEN NULL WHEN regexp_matches(parts[{k + 1}], '^[0-9]+([.][A-Za-z]+)?$') OR (regexp_matches(parts[{k + 1}], '[0-9]') AND length(parts[{k + 1}]) >= 8) OR parts[{k + 1}] IN ('*', '**') THEN '*' ELSE parts[{k + 1}] END AS seg FROM x{k}),
x{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (seg, tpl), tpl || CASE WHEN seg IS NULL THEN '' WHEN seg <> '*' AND count(*) OVER (PARTITION BY host, tpl, seg) >= {LEAST} AND count(*) OVER (PARTITION BY host, tpl, seg) >= {SHARE}e0 * count(seg) OVER (PARTITION BY host, tpl) THEN '/' || seg ELSE '/*' END AS tpl FROM g{k})""")
    return ",\n".join(out)


def _differ(a: str, n: str) -> str:
    b, m = f"(f_{a} - {a})", f"(f_{n} - {n})"
    return f"CASE WHEN {n} > 0 AND {m} > 0 THEN abs({a}::DOUBLE / {n} - {b}::DOUBLE / {m}) > {ALIKE}e0 * sqrt(f_{a}::DOUBLE / f_{n} * (1 - f_{a}::DOUBLE / f_{n}) * (1e0 / {n} + 1e0 / {m})) ELSE FALSE END"


def _purity(b: str, n: str, t: str, prior: str) -> str:
    return f"(({b} + {PRIOR} * {prior}) / ({n} + {UNLABELLED}e0 * ({t} - {n}) + {PRIOR}))"


OP10_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM h),
x0 AS MATERIALIZED (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled, '' AS tpl,
  list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM r),
{_levels()},
y AS MATERIALIZED (SELECT * EXCLUDE (tpl), tpl || CASE WHEN len(parts) > {DEPTH} THEN '/**' ELSE '' END AS tpl, parts[least(len(parts), {DEPTH + 1})] AS tail FROM x{DEPTH}),
s AS (SELECT host, tpl, count(*) AS pages, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked, count(*) FILTER (regexp_matches(tail, '^[0-9]')) AS numbers,
  count(*) FILTER (regexp_matches(tail, '\.[A-Za-z]+$')) AS files, count(*) FILTER (ends_with(path, '/')) AS slashes FROM y GROUP BY 1, 2),
k AS (SELECT host, tpl, string_split(tpl, '/') AS w, unnest(list_filter(range(1, len(string_split(tpl, '/')) + 1), lambda i: string_split(tpl, '/')[i] NOT IN ('', '*', '**'))) AS pos FROM s),
c AS (SELECT host, tpl, pos, array_to_string(list_transform(w, lambda x, i: CASE WHEN i = pos THEN '?' ELSE x END), '/') AS family FROM k),
b AS (SELECT host, tpl, family, row_number() OVER (PARTITION BY host, tpl ORDER BY n DESC, pos DESC) AS place FROM (SELECT *, count(*) OVER (PARTITION BY host, family) AS n FROM c)),
f AS (SELECT s.*, coalesce(b.family, s.tpl) AS family FROM s LEFT JOIN b ON s.host = b.host AND s.tpl = b.tpl AND b.place = 1),
g AS (SELECT *, {", ".join(f"sum({c}) OVER v AS f_{c}" for c in COUNTS)}, count(*) OVER v AS sisters, {", ".join(f"sum({c}) OVER o AS h_{c}" for c in COUNTS[:3])}, {", ".join(f"sum({c}) OVER () AS w_{c}" for c in COUNTS[:3])}
  FROM f WINDOW v AS (PARTITION BY host, family), o AS (PARTITION BY host)),
a AS (SELECT *, sisters > 1 AND NOT ({_differ("blocked", "labelled")} OR {" OR ".join(_differ(c, "pages") for c in ("numbers", "files", "slashes"))}) AS merges,
  {_purity("h_blocked", "h_labelled", "h_pages", f"((w_blocked + 1) / (w_labelled + {UNLABELLED}e0 * (w_pages - w_labelled) + 2))")} AS prior FROM g),
m AS (SELECT host, tpl, prior, {", ".join(f"CASE WHEN merges THEN sum(CASE WHEN merges THEN {c} ELSE 0 END) OVER (PARTITION BY host, family) ELSE {c} END AS {c}" for c in COUNTS[:3])} FROM a)
SELECT page_id, y.host, path, rule, coalesce(ruled, CASE WHEN {_purity("m.blocked", "m.labelled", "m.pages", "m.prior")} >= {PURITY}e0 THEN 'block' ELSE 'allow' END) AS verdict
FROM y JOIN m ON y.host = m.host AND y.tpl = m.tpl
"""
