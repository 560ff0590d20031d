"""URL rules as intervals of a sorted key, found by a sweep with a stack.

The key of a rule is its host with the labels reversed (``net.example``) and its
path. A host and all its subdomains share the reversed labels, so a url is
probed once under each ancestor host that can have a rule. Under one host a path
prefix is an interval of the sorted paths; intervals nest or are apart. A window
sorted by path sweeps rules and probes together and keeps for every nesting
level the rule opened last: the stack. The rules in it that still hold the
probe's path are all that fit.

Only DataFrame functions. Rules are copied to as many salts as there are shuffle
partitions and probes are dealt over them, so a host with a third of all urls is
swept by all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import ascii_lower, partitions

# No UTF-8 text holds this byte, so a path and it come after every text that begins with the path.
_LAST = b"\xff"


def url_host(url: Column) -> Column:
    """Lower-cased host after the first ``://``; empty without one."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def nested_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with key and nesting level, each once; block wins over allow."""
    once = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy(ascii_lower("host").alias("host"), "path")
        .agg(F.max("action").alias("action"))
        .withColumn("labels", F.size(F.split("host", r"\.")))
        .withColumn("key", F.array_join(_reversed_labels(F.col("host")), "."))
    )
    ends = F.array(
        F.struct(F.col("path").cast("binary").alias("at"), F.lit(1).alias("step")),
        F.struct(F.concat(F.col("path").cast("binary"), F.lit(_LAST)).alias("at"), F.lit(-1).alias("step")),
    )
    sweep = Window.partitionBy("key").orderBy("at", "step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        once.select("*", F.explode(ends).alias("e")).select("*", "e.at", "e.step").drop("e")
        .withColumn("level", F.sum("step").over(sweep))
        .where("step = 1")
        .select("host", "path", "action", "labels", "key", "level")
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: id, host, path, rule (NULL without one) and verdict.

    ``rules`` has host, path and action ('allow' or 'block'). A rule fits its host
    and all subdomains when the path starts with the rule's path. The longest rule
    (characters of host and path; then of the host) wins; no rule: ``default``.

    NULL or scheme-less urls have empty host and path and get the default. Repeated
    pages stay repeated. Other columns of ``pages`` are neither read nor returned,
    whatever their names. No pages: no rows; no rules: the default for all.
    """
    spark = pages.sparkSession
    nested = nested_rules(rules)
    most = nested.agg(F.max("labels").alias("labels"), F.max("level").alias("level")).first()
    depth, levels = most.labels or 1, most.level or 1

    page = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    page = page.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    labels = _reversed_labels(F.col("host"))
    salts = partitions(spark)
    probes = page.select(
        "id", "url", "path",
        F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))).alias("probe"),
        labels.alias("labels"),
    ).select(
        F.array_join(F.slice("labels", 1, F.col("probe")), ".").alias("key"), "salt", "path",
        F.lit(1).alias("kind"), "id", "url", "probe",
        F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("action"),
    )
    opened = nested.select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "path",
        F.lit(0).alias("kind"), F.lit(None).cast(pages.schema[id_col].dataType).alias("id"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("int").alias("probe"),
        F.col("level").cast("int"), "host", "action",
    )
    sweep = (
        Window.partitionBy("key", "salt").orderBy("path", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rule = F.struct("path", "host", "action")
    stack = F.array(*(
        F.last(F.when(F.col("level") == n, rule), ignorenulls=True).over(sweep)
        for n in range(1, levels + 1)
    ))
    fits = F.filter("stack", lambda r: r.isNotNull() & F.col("path").startswith(r["path"]))
    best = F.element_at(fits, -1)
    found = (
        probes.unionByName(opened).withColumn("stack", stack).where("kind = 1")
        .select("id", "url", "probe", F.when(F.size(fits) > 0, best).alias("r"))
        .groupBy("id", "url")
        .agg(
            F.max(F.when(F.col("r").isNotNull(), F.struct(
                F.length(F.concat("r.host", "r.path")).alias("size"),
                F.length("r.host").alias("host_size"),
                F.concat("r.host", "r.path").alias("rule"), F.col("r.action").alias("action"),
            ))).alias("r"),
            F.count_if(F.col("probe") == 1).alias("n"),
        )
    )
    return found.select(
        F.col("id").alias(id_col), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        F.col("r.rule").alias("rule"), F.coalesce("r.action", F.lit(default)).alias("verdict"),
        F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("_copy"),
    ).drop("_copy")
