"""URL filters: allow and block entries in a trie over reversed host labels and path segments; the longest entry wins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.llm.common import stored

ALLOW, BLOCK = "allow", "block"
# Entries are sent to every executor up to this many characters; longer lists are joined instead.
BROADCAST_CHARACTERS = 16_000_000


@dataclass(frozen=True)
class Rule:
    """An entry for ``host`` and all hosts below it, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


# The entries of the query.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


def after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? or #, with A-Z in lower case; else empty."""
    host = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; else empty."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Entries below their host labels, last label first, then below the full segments of their path.

    A path entry need not end at a segment, so a node holds the beginnings of the next segment that its entries ask for.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(("host", label), {})
            *segments, rest = rule.path.split("/")
            for segment in segments:
                node = node.setdefault(("path", segment), {})
            ends = node.setdefault("ends", [])
            # Of two entries for the same place the block entry wins.
            ends.append((len(rest), rule.verdict == BLOCK, rest, rule))
            ends.sort(key=lambda e: (-e[0], not e[1]))

    def find(self, host: str, path: str) -> Rule | None:
        """The entry with the longest fitting host and, among those, the longest path."""
        nodes, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            nodes.append(node)
        segments = path.split("/")
        for start in reversed(nodes):
            best, node, depth = None, start, 0
            while node is not None and depth < len(segments):
                rest = "/".join(segments[depth:])
                best = next((e[3] for e in node.get("ends", ()) if rest.startswith(e[2])), best)
                node = node.get(("path", segments[depth])) if depth < len(segments) - 1 else None
                depth += 1
            if best is not None:
                return best
        return None


def filter_urls(urls: DataFrame, rules: Sequence[Rule] = RULES, default: str = ALLOW, url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row; columns of these names are replaced.

    A null url, or one without ://, has an empty host and path and no entry fits it. Without a fitting entry the rule is
    null and the verdict ``default``. Every row keeps its place, repeated ones too.
    """
    rows = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if sum(len(rule.name) for rule in rules) > BROADCAST_CHARACTERS:
        return _joined(rows, rules, default)
    trie = urls.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [trie.value.find(host, path) for host, path in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(
                {
                    "rule": pd.Series([rule.name if rule else None for rule in found], dtype=object),
                    "verdict": [rule.verdict if rule else default for rule in found],
                }
            )

    judged = rows.withColumn("_judged", judge("host", "path"))
    return judged.withColumns(
        {"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")}
    ).drop("_judged")


def _joined(rows: DataFrame, rules: Sequence[Rule], default: str) -> DataFrame:
    """The same for a list too long to send: urls meet entries by host suffix and full path segments."""
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [
            (r.host, r.path.rpartition("/")[0] + "/" if "/" in r.path else "", r.path, r.name, r.verdict)
            for r in rules
        ],
        "_host string, _folder string, _path string, _rule string, _verdict string",
    )
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    labels = F.split("host", r"\.", -1)
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    parts = F.split("path", "/", -1)
    folders = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))),
    )
    keys = numbered.select("_row", "host", "path", F.explode(hosts).alias("_host"), folders.alias("_folders"))
    keys = keys.select("_row", "path", "_host", F.explode("_folders").alias("_folder"))
    best = (
        keys.join(table, ["_host", "_folder"])
        .where(F.col("path").startswith(F.col("_path")))
        .groupBy("_row")
        .agg(
            F.max(
                F.struct(
                    F.length("_host").alias("h"),
                    F.length("_path").alias("p"),
                    (F.col("_verdict") == BLOCK).alias("b"),
                    F.col("_rule").alias("rule"),
                    F.col("_verdict").alias("verdict"),
                )
            ).alias("_best")
        )
    )
    return (
        numbered.join(best, "_row", "left")
        .withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))})
        .drop("_row", "_best")
    )
