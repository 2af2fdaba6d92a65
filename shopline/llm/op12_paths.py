"""URL filter: a path-template tree per host, judged by labelled purity.

Rules (host, path, verdict) come first: a rule fits its host and all subdomains
where the path starts with the rule's; the longest one decides.  All other URLs
are judged by their template, in DataFrame operations only.

1. Each host's tree grows level by level over all URLs.  Below a branch, a
   segment value stays literal if it has ``SUPPORT`` URLs and ``SHARE`` of the
   branch's (so at most 1 / SHARE do); every other value is variable and
   becomes the wildcard of its class: ``{n}`` digits, ``{x}`` hex, ``{w}``
   letters, ``{s}`` anything else, with ``.ext`` behind where it has one.
2. Branches below one node that are statistically alike merge into ``*``: a
   branch is held against its siblings together, and merges if the share of each
   class of next segment, of ends, and of bad labels differ by no more than
   Hoeffding's bound at ``ALPHA``.  The next level goes on with the merged branch.
3. A template's purity is the share of good ones among its labelled URLs, smoothed
   by ``PRIOR`` URLs of its host's share, which is smoothed in turn by that
   of all.  Templates below ``CUT`` are rejected.

All statistics cover all URLs and are combined map-side.  Decisions are a few rows
per branch; they are joined back in ``SALTS`` copies to rows that carry a salt,
so a host or a template with a third of all URLs spreads over tasks.  Each
level's rows are stored; rows whose path has ended leave.

Edge cases: a null URL or one without ``://`` has empty host and path, fits no rule and is
judged like the host "" (without labels it is allowed); an empty path is the template of its
host alone; a path of more than ``DEPTH`` segments has all others in its last one,
whose value is ``{s}`` unless it is literal; repeated rows count each; a page without a label
counts for the tree but not for purity; an empty table gives an empty
result; extra columns take no part; null ids are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm.common import drop, lower_ascii, stored, table

#: Host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SUPPORT, SHARE, DEPTH = 20, 0.02, 8
ALPHA, PRIOR, CUT = 0.05, 10.0, 0.5
SALTS = 16
END = "<end>"
LABELS = ["lab", "bad"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; both empty where it has no ``://``."""
    # (?s): any character may stand in a URL, line ends too.
    part = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def segments(path: Column, depth: int = DEPTH) -> Column:
    """The parts between slashes after the first; at most ``depth``, the last with all the rest."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(path, "^/", ""), "/", depth))


def kind(segment: Column) -> Column:
    """The class of a segment's value, one of nine."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z0-9]{1,5}\z", "")
    ext = F.when((stem != "") & (stem != segment), F.lit(".ext")).otherwise(F.lit(""))
    stem = F.when(stem == "", segment).otherwise(stem)
    of = (F.when(stem.rlike(r"^[0-9]+\z"), F.lit("{n}")).when(stem.rlike(r"^[0-9a-fA-F]{8,}\z"), F.lit("{x}"))
          .when(stem.rlike(r"^[A-Za-z]+\z"), F.lit("{w}")).otherwise(F.lit("{s}")))
    return F.when(segment == "", segment).otherwise(F.concat(of, ext))


def _salted(decisions: DataFrame) -> DataFrame:
    """A copy of each decision for each salt."""
    return decisions.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("byte") for i in range(SALTS)])))


def _counts(extra: list[Column] | None = None) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.count("good").alias("lab"), F.count_if(~F.col("good")).alias("bad"), *(extra or [])]


def _literals(rows: DataFrame) -> DataFrame:
    """(host, template, segment) of the values that stay as they are."""
    of = ["host", "template"]
    branch = rows.groupBy(*of).agg(F.count(F.lit(1)).alias("all"))
    often = rows.groupBy(*of, "segment").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SUPPORT)
    return often.join(branch, of).filter(F.col("n") >= SHARE * F.col("all")).select(*of, "segment", F.col("segment").alias("literal"))


def hoeffding(a: Column, n: Column, b: Column, m: Column) -> Column:
    """True if the shares a of n and b of m may be equal."""
    x, y = F.greatest(n, F.lit(1)).cast("double"), F.greatest(m, F.lit(1)).cast("double")
    bound = F.sqrt(F.lit(0.5) * F.log(F.lit(2.0 / ALPHA))) * (1 / F.sqrt(x) + 1 / F.sqrt(y))
    return (n == 0) | (m == 0) | (F.abs(a / x - b / y) <= bound)


def _merged(rows: DataFrame) -> DataFrame:
    """(host, template, symbol) of the branches that are like their siblings.

    A node has at most 1 / SHARE literals and nine wildcards below it, and ten
    kinds of next segment, so its profile is a few rows.
    """
    of = ["host", "template"]
    profile = rows.groupBy(*of, "symbol", "next").agg(*_counts())
    nexts = F.map_from_entries(F.collect_list(F.struct("next", "n")))
    own = profile.groupBy(*of, "symbol").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in LABELS], nexts.alias("own"))
    by_next = profile.groupBy(*of, "next").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in LABELS])
    whole = by_next.groupBy(*of).agg(F.sum("n").alias("all_n"), *[F.sum(c).alias(f"all_{c}") for c in LABELS], nexts.alias("all"))
    both = own.join(whole, of)
    rest = F.col("all_n") - F.col("n")
    alike = F.forall(F.map_keys("all"), lambda k: hoeffding(
        F.coalesce(F.col("own")[k], F.lit(0)), F.col("n"), F.col("all")[k] - F.coalesce(F.col("own")[k], F.lit(0)), rest))
    alike &= hoeffding(F.col("bad"), F.col("lab"), F.col("all_bad") - F.col("bad"), F.col("all_lab") - F.col("lab"))
    return both.filter((rest > 0) & alike).select(*of, "symbol", F.lit("*").alias("merged"))


def _grown(rows: DataFrame, level: int) -> DataFrame:
    """The rows with one more segment of their template decided."""
    at = lambda i: F.get(F.col("segments"), F.lit(i))
    rows = rows.withColumn("segment", at(level))
    rows = rows.join(_salted(_literals(rows)), ["host", "template", "segment", "salt"], "left")
    following = F.when(F.size("segments") > level + 1, kind(at(level + 1))).otherwise(F.lit(END))
    rows = stored(rows.withColumns({"symbol": F.coalesce("literal", kind(F.col("segment"))), "next": following}).drop("literal", "segment"))
    out = rows.join(_salted(_merged(rows)), ["host", "template", "symbol", "salt"], "left")
    return out.withColumn("template", F.concat("template", F.lit("/"), F.coalesce("merged", "symbol"))).drop("symbol", "merged", "next")


def templates(urls: DataFrame) -> DataFrame:
    """Add ``template`` to rows with host, path and good (boolean, null where not labelled)."""
    rows = stored(urls.withColumns({"segments": segments(F.col("path")), "template": F.lit(""),
                                    "salt": (F.monotonically_increasing_id() % SALTS).cast("byte")}))
    done, level = [rows.filter(F.size("segments") == 0)], 0
    while level < DEPTH:
        rest = rows.filter(F.size("segments") > level)
        if rest.isEmpty():
            break
        rows, level = stored(_grown(rest, level)), level + 1
        done.append(rows.filter(F.size("segments") == level))
    return reduce(DataFrame.unionByName, done).drop("segments")


def judged(rows: DataFrame) -> DataFrame:
    """(host, template, lab, purity, verdict) of every template."""
    of = rows.groupBy("host", "template").agg(*_counts())
    good = F.col("lab") - F.col("bad")
    of_host = of.groupBy("host").agg(F.sum("lab").alias("host_lab"), F.sum(good).alias("host_good"))
    share = of_host.agg(F.try_divide(F.sum("host_good") + F.lit(1.0), F.sum("host_lab") + F.lit(1.0)).alias("s")).scalar()
    of_host = of_host.select("host", ((F.col("host_good") + PRIOR * share) / (F.col("host_lab") + F.lit(PRIOR))).alias("prior"))
    purity = (good + PRIOR * F.col("prior")) / (F.col("lab") + F.lit(PRIOR))
    out = of.join(of_host, "host").select("host", "template", "n", "lab", purity.alias("purity"))
    return out.withColumn("learned", F.when(F.col("purity") < CUT, F.lit("block")).otherwise(F.lit("allow")))


def filtered(pages: DataFrame, url: str = "url", keep: list[str] | None = None, good: Column | None = None,
             rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """The kept columns, host, path, rule, template, purity and verdict of every page.

    ``good`` is a page's label: true, false, or null where it has none.
    """
    keep = keep or ["page_id"]
    host, path = parts(F.col(url))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"), (F.lit(None) if good is None else good).cast("boolean").alias("good"))
    rows = stored(templates(rows))
    name, verdict = ruled(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.join(_salted(judged(rows)).drop("n", "lab"), ["host", "template", "salt"])
    return rows.select(*keep, "host", "path", name.alias("rule"), "template", "purity", F.coalesce(verdict, F.col("learned")).alias("verdict"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with ``good``: the label of the document whose id is the first number that begins a segment of the path.

    Good documents have quality 1 and are not toxic; of several labels the bad one counts.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(parts(F.col("url"))[1], "/([0-9]+)", 1)
    # Pages without a number get keys of their own, below all labels: equal ones would meet in one task.
    pages = pages.withColumn("__doc", F.coalesce(number.try_cast("bigint"), -1 - F.monotonically_increasing_id()))
    labels = table(spark, sf_dir, "labels").filter("doc_id >= 0")
    labels = labels.groupBy(F.col("doc_id").alias("__doc")).agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return pages.join(labels, "__doc", "left").drop("__doc")


def op12_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the rule that fits and the verdict of the rule or else of its template."""
    return filtered(labelled(spark, sf_dir), good=F.col("good")).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
