"""URL rules: a trie over reversed host labels and path segments, the longest match decides."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.llm.common import bound_batches

# The rules that one trie holds, in bytes of text; a longer list becomes several tries.
TRIE_BYTES = 16 << 20
# What a rule costs beside its text.
_RULE_BYTES = 64

VERDICTS = ("allow", "block")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    """A rule as written in a list, ``host/path``; the host's A-Z count as a-z."""
    if verdict not in VERDICTS:
        raise ValueError(f"{verdict!r} is not one of {VERDICTS}")
    host, slash, path = text.partition("/")
    if not host:
        raise ValueError(f"{text!r} names no host")
    return Rule(verdict, host.translate(str.maketrans(_UPPER, _UPPER.lower())), slash + path)


class Node:
    """A host label or a path segment.  ``ends`` are the rules that end here: what is left of the
    path after its last closed segment, longest first, with the rule."""

    __slots__ = ("labels", "segments", "ends")

    def __init__(self):
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.ends: list[tuple[str, Rule]] = []


class RuleTrie:
    """Rules by reversed host labels, then by path segments.

    A rule fits its host and all subdomains, if the path starts with the rule's path, letter by
    letter.  The longest rule wins: the one of most host labels, and of those the one of the
    longest path.  Of equal rules with different verdicts the blocking one counts.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = Node()
        # Allowing rules first, so that an equal blocking one replaces them.
        for rule in sorted(set(rules)):
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.labels.setdefault(label, Node())
            *closed, rest = rule.path.split("/")
            for segment in closed:
                node = node.segments.setdefault(segment, Node())
            node.ends = [(r, x) for r, x in node.ends if r != rest] + [(rest, rule)]
            node.ends.sort(key=lambda end: -len(end[0]))

    def find(self, host: str, path: str) -> Rule | None:
        """The rule that decides, in steps bounded by the depth of the trie."""
        chain = []
        node = self.root
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            chain.append(node)
        for node in reversed(chain):
            found = _longest(node, path)
            if found is not None:
                return found
        return None


def _longest(node: Node, path: str) -> Rule | None:
    """The longest path rule below the node of a host."""
    best, at = None, 0
    while node is not None:
        for rest, rule in node.ends:
            if path.startswith(rest, at):
                best = rule
                break
        slash = path.find("/", at)
        if slash < 0:
            break
        node = node.segments.get(path[at:slash])
        at = slash + 1
    return best


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty
    without ``://`` and for NULL."""
    return F.translate(F.regexp_extract(_after(url), r"\A([^/?#]*)", 1), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"\A[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _blocks(rules: Iterable[Rule]) -> Iterator[list[Rule]]:
    """Rules in lists of a bounded size, in the given order."""
    block, held = [], 0
    for rule in rules:
        size = len(rule.name.encode()) + _RULE_BYTES
        if block and held + size > TRIE_BYTES:
            yield block
            block, held = [], 0
        block.append(rule)
        held += size
    if block:
        yield block


_FOUND = T.StructType(
    [
        T.StructField("labels", T.IntegerType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("blocks", T.BooleanType()),
        T.StructField("rule", T.StringType()),
    ]
)


def _walked(shared: Broadcast):
    """The rule of one block that decides, for a host and a path."""

    @F.pandas_udf(_FOUND)
    def walk(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = RuleTrie(shared.value)
        for hosts, paths in batches:
            out = []
            for host, path in zip(hosts, paths, strict=True):
                rule = trie.find(host, path)
                if rule is None:
                    out.append((-1, -1, False, None))
                else:
                    out.append((rule.host.count("."), len(rule.path), rule.verdict == "block", rule.name))
            yield pd.DataFrame(out, columns=_FOUND.names)

    return walk


def judge_urls(urls: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``, all other columns as they are; columns of these
    four names are replaced.

    ``rule`` is the rule that decides, as it is written, NULL if none fits; then the verdict is
    ``default``.  A NULL or empty URL and one without ``://`` have an empty host, which no rule
    fits.  Repeated rows are judged one by one, whole URLs of any length are read, and an empty
    table or list gives what it should: no rows, or ``default`` everywhere.

    Rows stay where they are.  A task walks a broadcast trie; a list longer than ``TRIE_BYTES``
    is cut into several tries, one step each, of which the longest match counts, so what a
    worker builds at a time is bounded.
    """
    if default not in VERDICTS:
        raise ValueError(f"{default!r} is not one of {VERDICTS}")
    spark = urls.sparkSession
    bound_batches(spark)
    url = F.col(url_col)
    rows = urls.withColumns({"host": host_of(url), "path": path_of(url)})
    best = F.lit(None).cast(_FOUND)
    for block in _blocks(rules):
        # The order of the fields is the order of precedence.
        best = F.greatest(best, _walked(spark.sparkContext.broadcast(block))("host", "path"))
    rows = rows.withColumn("__best", best)
    rule = F.col("__best.rule")
    verdict = F.when(rule.isNull(), default).when(F.col("__best.blocks"), "block").otherwise("allow")
    return rows.withColumns({"rule": rule, "verdict": verdict}).drop("__best")


def drop_blocked(urls: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` without the rows that the rules block, columns as they are."""
    plain = urls.withColumn("__url", F.col(url_col))
    judged = judge_urls(plain.select(F.struct(*urls.columns).alias("__row"), "__url"), rules, "__url", default)
    return judged.where("verdict = 'allow'").select("__row.*")
