"""Judges URLs by host and path rules and by a list of canonical URLs behind a blocked Bloom filter (operator 6)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm import bloom
from casewright.llm.common import join_unique
from casewright.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
#: Parameters that say where a visitor came from, not what the page is.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _HOST_PATH, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _HOST_PATH, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or a default port, path without a last slash, other parameters sorted; "" without a host.

    Scheme, fragment and tracking parameters do not matter.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    parameters = F.array_sort(F.filter(F.split(F.coalesce(F.regexp_extract(url, _QUERY, 1), F.lit("")), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))).otherwise("")
    return F.when(host == "", "").otherwise(F.concat(host, F.regexp_replace(path_of(url), "/$", ""), query))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule name or null, verdict or null) of the longest rule that fits."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    return (name, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (``block`` or ``allow``).

    A rule decides where one fits, the longest if several do. Elsewhere a URL is blocked if its canonical form is that of
    a URL in ``listed``. The list goes out as a Bloom filter of bounded size; only what may be on it is joined to the
    list itself, so false hits are allowed and the other rows are not shuffled. URLs that are null or have no ``://``
    have no host and are allowed. Repeated rows are judged each; columns named like the four results are replaced.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    keys = stage(listed.select(canonical(F.col(listed_col)).alias("key")).filter("key <> ''").groupBy("key").agg(F.count("*").alias("on_list")), "url-list")
    words = bloom.build(keys.select(F.xxhash64("key").alias("h")), lambda b: b.column("h").to_numpy().view(np.uint64), bloom.bits_for(keys.count()), "url-filter")[0]
    shared = bloom.share(pages, words)

    @F.pandas_udf("boolean")
    def may_be_listed(h: pd.Series) -> pd.Series:
        return pd.Series(bloom.holds(shared.value, h.to_numpy(np.int64).view(np.uint64)))

    seen = pages.select(*names, F.col(url_col).alias("__url")).select(
        *names, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"), canonical(F.col("__url")).alias("__key"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    seen = seen.withColumns({"rule": rule, "verdict": verdict}).withColumn("__maybe", may_be_listed(F.xxhash64("__key")) & F.col("verdict").isNull())
    clear = seen.filter(~F.col("__maybe")).select(*names, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    doubtful = seen.filter("__maybe")
    total = doubtful.count()
    counts = doubtful.groupBy("__key").agg(F.count("*").alias("__n"))
    hits = counts.join(keys.select(F.col("key").alias("__key"), F.lit(True).alias("__hit")), "__key", "left")
    judged = join_unique(doubtful, stage(hits, "url-hits"), "__key", "__n", total, "inner")
    return clear.unionByName(judged.select(*names, "host", "path", "rule", F.when(F.col("__hit"), "block").otherwise("allow").alias("verdict")))
