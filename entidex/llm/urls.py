"""URL rules: expressions of host suffixes and path prefixes, met by hash.

A rule is a host, a path and a verdict. It fits its host and all subdomains of it, where the
path of the URL starts with the rule's; of several the longest wins.

Every URL is expanded into the texts `host suffix + path prefix` that a rule could have.
Suffixes start at a label, and only lengths that occur in the rules are cut, so neither a
host of a million labels nor a path of a million parts makes more than the rules ask for.
Expressions meet the rules by an equi-join on the first `PREFIX` digits of their digests;
whole digests then confirm. What is left is one aggregation per URL that keeps the rule of
the highest rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entidex.llm.common import importable, scratch, written

#: Hex digits of a digest on which expressions and rules are joined.
PREFIX = 8
#: What holds where no rule fits.
DEFAULT = "allow"
#: Between host and path in the text that is hashed; no host holds it.
BETWEEN = "/"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Text after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest_of(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(BETWEEN), path), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """`prefix`, `digest`, `host_length`, `path_length`, `rule`, `verdict` of each distinct rule.

    A rule with a null is none, and one whose host holds `/`, `?` or `#` fits no URL. Of rules
    with the same host and path, block holds.
    """
    host = F.translate("host", UPPER, LOWER)
    whole = rules.select(host.alias("host"), "path", "verdict").dropna().filter(~F.col("host").rlike("[/?#]"))
    one = whole.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' comes after 'allow'
    digest = digest_of(F.col("host"), F.col("path"))
    lengths = F.char_length("host").alias("host_length"), F.char_length("path").alias("path_length")
    return one.select(F.substring(digest, 1, PREFIX).alias("prefix"), digest.alias("digest"), *lengths, F.concat("host", "path").alias("rule"), "verdict")


def rule_lengths(prepared: DataFrame) -> dict[int, list[int]]:
    """Path lengths by host length. At most as many as the longest host and path are long, however many rules there are."""
    rows = prepared.groupBy("host_length").agg(F.sort_array(F.collect_set("path_length")).alias("of")).collect()
    return {r["host_length"]: list(r["of"]) for r in rows}


def expressions(parts: DataFrame, lengths: dict[int, list[int]]) -> DataFrame:
    """`row`, `prefix` and `digest` of every host suffix and path prefix of the given lengths.

    parts: `row`, `host`, `path`.
    """
    table = F.array(*[F.struct(F.lit(h).alias("h"), F.array(*map(F.lit, p)).alias("p")) for h, p in sorted(lengths.items())])
    size = F.char_length("host")
    # The host itself, or what follows a dot.
    at_label = lambda x: (x["h"] == size) | ((x["h"] < size) & (F.substr("host", size - x["h"], F.lit(1)) == "."))
    suffixes = parts.select("row", "host", "path", F.explode(F.filter(table, at_label)).alias("x"))
    suffix = F.substr("host", F.char_length("host") - F.col("x.h") + 1)
    cut = suffixes.select("row", suffix.alias("suffix"), "path", F.explode(F.filter("x.p", lambda p: p <= F.char_length("path"))).alias("p"))
    digest = digest_of(F.col("suffix"), F.substr("path", F.lit(1), F.col("p")))
    return cut.select("row", digest.alias("digest")).select("row", F.substring("digest", 1, PREFIX).alias("prefix"), "digest")


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """Per row of `urls`: `id_col`, host, path, rule (host and path, or null) and verdict.

    rules: host, path, verdict (allow or block). The longest rule that fits wins; of equally
    long ones that with the longer host, then block. Where none fits, rule is null and the
    verdict is `default`. A null URL and one without `://` have an empty host and path, which
    only rules with an empty host can fit. Repeated rows and ids repeat, each judged alone; a
    URL of any length is taken whole; an empty table of URLs gives none, one of rules gives
    `default` everywhere. Other columns are not read.
    """
    folder = scratch(urls.sparkSession)
    # Written, so that a row keeps its number whenever a task is run again.
    numbered = importable(urls).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parts = written(numbered, folder, "parts")
    known = prepared_rules(rules)
    lengths = rule_lengths(known)
    if not lengths:
        return parts.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Spark broadcasts the rules where they are small enough; if not, it splits the hot prefixes.
    met = expressions(parts, lengths).alias("e").join(known.alias("k"), F.col("e.prefix") == F.col("k.prefix"))
    sure = met.filter(F.col("e.digest") == F.col("k.digest"))
    rank = F.struct((F.col("host_length") + F.col("path_length")).alias("long"), "host_length", "rule", "verdict")
    best = sure.groupBy("row").agg(F.max(rank).alias("best"))
    found = parts.join(best, "row", "left")
    return found.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
