"""robots.txt: decisions from fetch results as Columns, and a table of rules, for which each file is parsed once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from granary.functions.ids import robots_url

USER_AGENT = "granary/1.0 (+contact@example.com)"
TTL_SECONDS = 3600


def status_verdict(status: Column) -> Column:
    """struct(verdict, cached) by HTTP status, null for a network error: 'rules' (the file decides), 'allow' or 'deny'."""
    verdict = F.when(status.isNull(), "deny").when(status.isin(429, 451), "deny").when((status >= 400) & (status < 500), "allow").when(status >= 500, "deny").otherwise("rules")
    cached = status.isNotNull() & (status < 500)
    return F.struct(verdict.alias("verdict"), F.coalesce(cached, F.lit(False)).alias("cached"))


#: What ends a line of a file.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
BLANK, AGENT, RULE = 0, 1, 2
RULES = T.ArrayType(T.StructType().add("path", T.StringType()).add("allow", T.BooleanType()))


def unquoted(x: Column) -> Column:
    """A URL's text without percent escapes; what is none stays as it is."""
    safe = F.regexp_replace(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.url_decode(safe)


def quoted(x: Column) -> Column:
    """A path's text with percent escapes for all but letters, digits and _.-~/"""
    out = F.url_encode(x)
    for found, to in ((r"\+", "%20"), ("%2F", "/"), ("%7E", "~"), (r"\*", "%2A")):
        out = F.regexp_replace(out, found, to)
    return out


def _whole(path: Column) -> Column:
    """A path with its query and fragment, where these are not empty."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"[\t\r\n]", ""), r"#\z", ""), r"\?(?=#|\z)", "")


def path_of(url: Column) -> Column:
    """What the rules of a file are compared with."""
    path = quoted(_whole(F.regexp_replace(unquoted(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")))
    return F.when(path == "", "/").otherwise(path)


def file_rules(files: DataFrame, agent: str = USER_AGENT) -> DataFrame:
    """robots_url, rules (path and allow, in the file's order), delay, any_delay: what each file of files(robots_url, body) says to an
    agent and to all. Each file is parsed once.

    An empty line ends an entry, as does a user-agent line behind rules; an entry needs both. The first entry that names a part of the
    agent's token counts, else the first for all (*). No entry: no rules. Of an entry's delays the last whole number counts."""
    bare = lambda c: F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")
    line = bare(F.regexp_replace("line", "#.*", ""))
    lines = files.select("robots_url", F.posexplode(F.split(F.coalesce("body", F.lit("")), LINE_END)).alias("at", "line"))
    cut = lines.select("robots_url", "at", (F.col("line") == "").alias("blank"), F.lower(bare(F.substring_index(line, ":", 1))).alias("name"), F.when(line.contains(":"), bare(F.regexp_replace(line, r"\A[^:]*:", ""))).alias("given"))
    name, given = F.col("name"), F.col("given")
    kind = F.when(F.col("blank"), BLANK).when(given.isNotNull() & (name == "user-agent"), AGENT).when(given.isNotNull() & name.isin("allow", "disallow", "crawl-delay", "request-rate"), RULE)
    told = cut.withColumns({"kind": kind, "value": unquoted(given)}).where("kind is not null")
    w = W.Window.partitionBy("robots_url").orderBy("at")
    starts = (F.col("kind") == BLANK) | ((F.col("kind") == AGENT) & ~(F.lag("kind", 1, BLANK).over(w) <= AGENT))
    entries = told.withColumn("starts", starts.cast("int")).withColumn("entry", F.sum("starts").over(w)).where(F.col("kind") != BLANK)
    rule = F.struct("at", F.struct(quoted(_whole(F.col("value"))).alias("path"), ((name == "allow") | (F.col("value") == "")).alias("allow")).alias("rule"))
    number = (name == "crawl-delay") & F.col("value").rlike(r"\A[0-9]+\z")
    parsed = entries.groupBy("robots_url", "entry").agg(
        F.collect_list(F.when(F.col("kind") == AGENT, F.lower("value"))).alias("agents"), F.count_if(F.col("kind") == RULE).alias("n"),
        F.array_sort(F.collect_list(F.when(name.isin("allow", "disallow"), rule))).alias("rules"), F.max_by(F.when(number, F.col("value").try_cast("double")), F.when(number, F.col("at"))).alias("delay"),
    ).where((F.col("n") > 0) & (F.size("agents") > 0))
    token, anyone = agent.partition("/")[0].lower(), F.array_contains("agents", "*")
    first = lambda test: F.min_by(F.struct("rules", "delay"), F.when(test, F.col("entry")))
    named = lambda by: ~anyone & F.exists("agents", lambda a: F.lit(by).contains(a))
    told = parsed.groupBy("robots_url").agg(first(named(token)).alias("own"), first(named("*")).alias("star"), first(anyone).alias("all"))
    own, all_ = F.coalesce("own", "all"), F.coalesce("star", "all")
    known = told.select("robots_url", F.transform(own["rules"], lambda r: r["rule"]).alias("rules"), own["delay"].alias("delay"), all_["delay"].alias("any_delay"))
    return files.select("robots_url").distinct().join(known, "robots_url", "left")


def allows(rules: Column, path: Column) -> Column:
    """What the first rule that begins the path says; allowed where none does."""
    return F.coalesce(F.get(F.filter(rules, lambda r: path.startswith(r["path"])), F.lit(0))["allow"], F.lit(True))


def crawl_delay(agent: Column, anyone: Column) -> Column:
    """The agent's own delay; where that is absent or zero, the one for all."""
    return F.coalesce(F.nullif(agent, F.lit(0.0)), anyone)


def decide(urls: DataFrame, robots: DataFrame, now: Column, host_cached: bool = False) -> DataFrame:
    """urls(url, ...) with allowed and delay from robots(robots_url, status, body, fetched_at). Unknown and expired hosts are denied; of
    a host's answers the latest counts. A host's file is parsed once, and its rules meet the host's URLs.

    host_cached: the first URL (by seq) of a host decides for all of them, as with a cache by host.
    """
    if "fetched_at" in robots.columns:
        live = robots.where(F.col("fetched_at") > now - F.expr(f"INTERVAL {TTL_SECONDS} SECONDS"))
        live = live.groupBy("robots_url").agg(F.max_by(F.struct("status", "body"), "fetched_at").alias("a")).select("robots_url", "a.*")
    else:
        live = robots.groupBy("robots_url").agg(F.max(F.struct("status", "body")).alias("a")).select("robots_url", "a.*")
    judged = live.select("robots_url", "body", status_verdict(F.col("status"))["verdict"].alias("_v"))
    ruled = file_rules(judged.where("_v = 'rules'")).select("robots_url", F.col("rules").alias("_rules"), crawl_delay(F.col("delay"), F.col("any_delay")).alias("delay"))
    hosts = judged.drop("body").join(ruled, "robots_url", "left")
    joined = urls.withColumn("robots_url", robots_url(F.col("url"))).join(hosts, "robots_url", "left")
    allowed = F.when(F.col("_v") == "rules", allows(F.col("_rules"), path_of(F.col("url")))).otherwise(F.coalesce(F.col("_v") == "allow", F.lit(False)))
    out = joined.select(*urls.columns, "robots_url", allowed.alias("allowed"), "delay")
    if host_cached:
        first = out.groupBy("robots_url").agg(F.min_by(F.struct("allowed", "delay"), "seq").alias("_first"))
        out = out.drop("allowed", "delay").join(first, "robots_url", "left").select("*", "_first.allowed", "_first.delay").drop("_first")
    return out.drop("robots_url")


def http_get(url: str, timeout: float = 10.0) -> tuple[int | None, str | None]:
    """Status and body of a robots.txt; no status where there was no answer."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": USER_AGENT}), timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", errors="replace")
    except urllib.error.HTTPError as e:
        return e.code, None
    except (urllib.error.URLError, TimeoutError, OSError):
        return None, None


def fetched(urls: DataFrame, known: DataFrame | None = None, now: Column | None = None, get: Callable[[str], tuple[int | None, str | None]] = http_get, tasks: int = 8) -> DataFrame:
    """robots_url, status, body, fetched_at of each host of urls(url): one call a host, none for those that `known` has within TTL_SECONDS."""
    now = F.current_timestamp() if now is None else now
    hosts = urls.select(robots_url(F.col("url")).alias("robots_url")).where("robots_url is not null").distinct()
    if known is not None:
        fresh = known.where(F.unix_micros(now) - F.unix_micros("fetched_at") < TTL_SECONDS * 1_000_000).select("robots_url").distinct()
        hosts = hosts.join(fresh, "robots_url", "left_anti")

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, *get(u)) for u in batch["robots_url"]]
            yield pd.DataFrame(rows, columns=["robots_url", "status", "body"]).astype({"status": "Int32"})

    return hosts.repartition(tasks, "robots_url").mapInPandas(call, "robots_url string, status int, body string").withColumn("fetched_at", now.cast("timestamp"))
