"""URL filters: longest matching path rule first, a list of blocked URLs for the rest.

The list becomes a blocked Bloom filter, a table of 256-bit blocks.  A page's URL looks
into the one block its hash names; only pages whose bits are all set go on to an exact
join with the list, which removes false positives.  Both joins are plain equi-joins, so
Spark broadcasts a side only when its own size check allows, and otherwise shuffles.

A null or unparsable URL has an empty host and path, fits no rule and is on no list, so
the verdict is ``allow``.  Repeated rows are judged one by one; a repeated list entry
counts once.  An empty list blocks nothing.  Input columns keep their names; the result
columns ``host``, ``path``, ``rule`` and ``verdict`` replace columns of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from clickshop.llm.common import field, free_name, others

#: Bits of a block, as four longs, and how many of them an entry sets.
WORDS, PROBES = 4, 6
#: Entries that share one block on average: about 16 bits an entry.
PER_BLOCK = 16

# Query parameters that name a visit rather than a page.
TRACKING = r"(utm_[^=&]*|ref|fbclid|gclid|sessionid)"


@dataclass(frozen=True)
class PathRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and path; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def canonical(url: Column) -> Column:
    """One spelling per page: no scheme, default port, fragment, tracking or final slash.

    Null for a URL without ``://``.
    """
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(^|&){TRACKING}=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    path = F.regexp_replace(path, "/+$", "")
    full = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), full)


def fitting_rule(host: Column, path: Column, rules: tuple[PathRule, ...]) -> Column:
    """The longest rule that fits, as struct of ``rule`` and ``verdict``; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    cases = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ordered
    ]
    return F.coalesce(*cases) if cases else F.lit(None).cast("struct<rule:string,verdict:string>")


def _bits(key: Column) -> tuple[list[Column], Column]:
    """The words with an entry's bits, and a second hash for choosing the block."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    places = [
        F.shiftrightunsigned(first, 8 * k).bitwiseAND(F.lit(64 * WORDS - 1)) for k in range(PROBES)
    ]
    words = [
        reduce(
            Column.bitwiseOR,
            [
                F.when(
                    F.shiftright(p, 6) == w,
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(63).cast("int")),
                ).otherwise(F.lit(0).cast("bigint"))
                for p in places
            ],
        )
        for w in range(WORDS)
    ]
    return words, second


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter over ``keys``: one row per block that holds an entry."""
    words, second = _bits(F.col(key))
    return (
        keys.select(
            F.pmod(second, F.lit(blocks)).alias("block"),
            *[w.alias(f"w{i}") for i, w in enumerate(words)],
        )
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    )


def may_contain(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The ``rows`` whose ``key`` has all its bits set in the filter."""
    words, second = _bits(F.col(key))
    block = F.pmod(second, F.lit(blocks))
    hit = reduce(
        Column.__and__, [w.bitwiseAND(F.col(f"_f.w{i}")) == w for i, w in enumerate(words)]
    )
    return rows.join(bloom.alias("_f"), block == F.col("_f.block")).filter(hit).select(*rows.columns)


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: tuple[PathRule, ...], url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``listed`` has a column ``url``.  Rules decide first; other pages are blocked when
    their canonical URL is listed.
    """
    entries = (
        listed.select(canonical(F.col("url")).alias("_url")).filter("_url is not null").distinct()
    )
    blocks = max(1, -(-entries.count() // PER_BLOCK))
    bloom = bloom_blocks(entries, "_url", blocks)
    host, path = host_and_path(F.col(url))
    fit, page = free_name(pages, "fit"), free_name(pages, "page")
    judged = pages.select(
        *[field(c) for c in others(pages, "host", "path", "rule", "verdict")],
        host.alias("host"),
        path.alias("path"),
        fitting_rule(host, path, rules).alias(fit),
        canonical(F.col(url)).alias(page),
    )
    open_urls = judged.filter(F.col(fit).isNull() & F.col(page).isNotNull())
    # Pages of one URL agree, so the candidates shrink to distinct URLs before the joins.
    distinct = open_urls.select(F.col(page).alias("_url")).distinct()
    possible = may_contain(distinct, "_url", bloom, blocks)
    blocked = possible.join(entries, "_url", "left_semi")
    return (
        judged.join(blocked, judged[page] == blocked["_url"], "left")
        .withColumn("rule", F.col(fit)["rule"])
        .withColumn(
            "verdict",
            F.coalesce(
                F.col(fit)["verdict"],
                F.when(blocked["_url"].isNotNull(), F.lit("block")),
                F.lit("allow"),
            ),
        )
        .drop(fit, page)
        .drop(blocked["_url"])
    )
