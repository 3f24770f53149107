"""URL allow / block filter: a trie over reversed host labels, then path segments.

Each rule is (host, path, verdict): it fits its host and every subdomain, when the URL's path starts
with the rule's path (a plain string prefix, so ``/en/`` does not fit ``/en`` and ``/a`` fits
``/ab``). Among fitting rules the longest decides: most host labels first, then the longest path;
if the same (host, path) is both allowed and blocked, block wins. URLs no rule fits get ``default``.

The trie is broadcast. Rules are a list the caller holds, so the whole set is driver-sized; still, no
broadcast object grows without bound: above ``max_rules_per_trie`` the sorted rules are cut into
several tries, applied one after another in the same pass, and the longest match over all of them
is kept -- the same result.

Nulls and odd input: a null URL, or one without ``://``, has an empty host and path and takes the
default (no host label is empty, so nothing fits an empty host). Repeated rows are judged one by
one. Extra columns are kept; output names that clash with input columns replace nothing: the caller
names them (``columns``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewatch.llm.common import free_name

Rule = tuple[str, str, str]  # host, path (empty or starting with "/"), "allow" | "block"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    bare = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.instr(bare, "/")
    return F.when(slash > 0, bare.substr(slash, F.length(bare))).otherwise(F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))


class UrlTrie:
    """Nested dicts: host labels from the top-level domain down, then whole path segments. A node's
    ``""`` entry holds the rules that end there, as (rest of a last, partial segment) -> rule."""

    HOST_END = "/"  # no host label contains a slash

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(self.HOST_END, {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(("/", segment), {})
            ends = node.setdefault("", {})
            if verdict == "block" or rest not in ends:
                ends[rest] = (host + path, verdict)

    def match(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """Longest fitting rule as (host labels, path length, rule, verdict)."""
        node, best = self.root, None
        if not host:
            return None
        segments = path.split("/")
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.get(label)
            if node is None:
                break
            below = node.get(self.HOST_END)
            if below is not None:
                found = self._path(below, segments)
                if found is not None:
                    best = (depth, *found)
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[int, str, str] | None:
        best, used = None, 0
        for segment in segments:
            for rest, (rule, verdict) in node.get("", {}).items():
                if segment.startswith(rest) and (best is None or used + len(rest) >= best[0]):
                    best = (used + len(rest), rule, verdict)
            node = node.get(("/", segment))
            if node is None:
                break
            used += len(segment) + 1
        return best


def filter_urls(
    df: DataFrame,
    url: str,
    rules: Sequence[Rule],
    default: str = "allow",
    columns: tuple[str, str, str, str] = ("host", "path", "rule", "verdict"),
    max_rules_per_trie: int = 100_000,
) -> DataFrame:
    """``df`` with host, path, rule (null if none fits) and verdict of its URL column."""
    host_c, path_c, rule_c, verdict_c = columns
    if clash := {c.lower() for c in columns} & {c.lower() for c in df.columns}:
        raise ValueError(f"output columns {sorted(clash)} exist already; pass other names in columns=")
    for host, path, verdict in rules:
        if not host or verdict not in ("allow", "block") or (path and not path.startswith("/")):
            raise ValueError(f"not a rule: {(host, path, verdict)}")
    ordered = sorted(set(rules))
    tries = [
        df.sparkSession.sparkContext.broadcast(UrlTrie(ordered[i : i + max_rules_per_trie]))
        for i in range(0, len(ordered), max_rules_per_trie)
    ]
    parts = df.withColumns({host_c: url_host(F.col(url)), path_c: url_path(F.col(url))})
    found = free_name(parts, "_match")

    def judge(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        rules_out, verdicts = [], []
        for host, path in zip(hosts.to_pylist(), paths.to_pylist()):
            # Longest first; the same rule in two tries is impossible, equal length means block vs allow.
            hits = [m for t in tries if (m := t.value.match(host, path)) is not None]
            best = max(hits, key=lambda m: (m[0], m[1], m[3] == "block"), default=None)
            rules_out.append(best[2] if best else None)
            verdicts.append(best[3] if best else default)
        return pa.StructArray.from_arrays([pa.array(rules_out, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    kind = StructType([StructField("rule", StringType()), StructField("verdict", StringType())])
    judged = parts.withColumn(found, F.arrow_udf(judge, kind)(F.col(host_c), F.col(path_c)))
    return judged.withColumns({rule_c: F.col(found)["rule"], verdict_c: F.col(found)["verdict"]}).drop(found)
