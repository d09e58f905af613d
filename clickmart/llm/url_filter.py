"""URL filter with rules indexed by their rarest literal token (operator 7).

A rule is a pattern of host and path: ``*`` stands for any characters, the host
part also fits subdomains, the path part fits as a prefix. The tokens that any
fitting URL must hold whole are the rule's literal tokens; their frequencies
over all URLs are counted by Spark, and the rule is filed under its rarest.
A URL's tokens fetch the candidate rules, and only those run their regular
expression. Rules without a literal token are tried on every URL.

The rule list is configuration. At most PART_RULES rules are sent to the tasks
at a time; a longer list takes one pass over the URLs for each part, which
keeps the best rule so far. Token frequencies are counted in a join with the
table of the rules' tokens and come back for these only. A task compiles a
rule when a URL first fetches it.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule; host and path are matched apart, so line ends in them (or any other
character) mean nothing special; among fitting rules the longest (host and
path) wins, then the last in order; without a rule the verdict is ``allow``;
urls of any length are matched whole; repeated rows return once each; an empty
table returns no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import column, stored

PART_RULES = 100_000  # rules sent to the tasks at a time
SENT_TOKENS = 100_000  # up to so many rule tokens are broadcast to be counted
TOKEN = re.compile(r"[a-z0-9]+")
BEST = "struct<named:boolean,size:bigint,place:bigint,rule:string,action:string>"
STATE = f"page_id long, url string, host string, path string, best {BEST}"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path

    def regex(self) -> tuple[re.Pattern, re.Pattern]:
        """Of the whole host, and of the path's beginning."""
        part = lambda s: ".*".join(map(re.escape, s.split("*")))
        return re.compile(rf"(?:.*\.)?{part(self.host)}\Z", re.S), re.compile(part(self.path), re.S)

    def tokens(self) -> set[str]:
        """Tokens that stand whole in every URL that fits."""
        found = set()
        for s, starts, ends in ((self.host.lower(), True, True), (self.path.lower(), True, False)):
            for m in TOKEN.finditer(s):
                left = s[m.start() - 1] != "*" if m.start() else starts
                right = s[m.end()] != "*" if m.end() < len(s) else ends
                found |= {m.group()} if left and right else set()
        return found


# The rules of the contract, then the method's own patterns.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
PATTERNS = (
    Rule("block", "spam-farm.*", ""),
    Rule("block", "adserver.*", ""),
    Rule("block", "*", "/wp-login.php"),
)


def split_url(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[at + 3:], re.S).groups()
    return re.sub("[A-Z]+", lambda m: m.group().lower(), host), path


def url_tokens(host: str, path: str) -> set[str]:
    return set(TOKEN.findall(f"{host}\n{path}".lower()))


def token_counts(pages: DataFrame, wanted: set[str]) -> dict[str, int]:
    """How many URLs hold each wanted token, over all rows."""
    if not wanted:
        return {}
    mine = pages.sparkSession.createDataFrame([(t,) for t in sorted(wanted)], "t string")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit("([a-z0-9]+)"), 1))
    seen = pages.select(F.explode(tokens).alias("t"))
    if len(wanted) <= SENT_TOKENS:
        counts = seen.join(F.broadcast(mine), "t").groupBy("t").agg(F.count("*").alias("n"))
    else:
        counts = seen.groupBy("t").agg(F.count("*").alias("n")).join(mine, "t")
    return {r["t"]: r["n"] for r in counts.collect()}


def build_index(rules: list[tuple[int, Rule]], counts: dict[str, int]) -> tuple[dict, list]:
    """Rules (with their places in the list) by their rarest token, and the rules that have none."""
    index, always = defaultdict(list), []
    for order, rule in rules:
        tokens = rule.tokens()
        if tokens:
            index[min(tokens, key=lambda t: (counts.get(t, 0), t))].append((order, rule))
        else:
            always.append((order, rule))
    return dict(index), always


def judge(host: str, path: str, tokens: set[str], index: dict, always: list, regex: dict) -> tuple[int, int, Rule] | None:
    """The longest rule that fits, after its length and place."""
    best = None
    for order, rule in [*always, *(e for t in tokens for e in index.get(t, ()))]:
        if best is None or (len(rule.text), order) > best[:2]:
            if order not in regex:
                regex[order] = rule.regex()
            of_host, of_path = regex[order]
            if of_host.match(host) and of_path.match(path):
                best = len(rule.text), order, rule
    return best


def _best(pages: DataFrame, rules: list[tuple[int, Rule]], n_rules: int, counts: dict[str, int]) -> DataFrame:
    """``pages`` (page_id, url, host, path, best) with the best of these rules and the one before, in ``best``: an own rule's
    place is below ``n_rules``, a pattern's from there on."""
    own, other = [r for r in rules if r[0] < n_rules], [r for r in rules if r[0] >= n_rules]
    shared = pages.sparkSession.sparkContext.broadcast((build_index(own, counts), build_index(other, counts)))

    def apply(batches):
        regex: dict = {}
        for batch in batches:
            hosts, paths, found = [], [], []
            for url, before in zip(column(batch, "url").to_pylist(), column(batch, "best").to_pylist(), strict=True):
                host, path = split_url(url)
                best = before and (before["named"], before["size"], before["place"])
                if host or path:
                    tokens = url_tokens(host, path)
                    for named, part in zip((True, False), shared.value, strict=True):
                        got = judge(host, path, tokens, *part, regex)
                        if got and (best is None or (named, *got[:2]) > best):
                            best = (named, *got[:2])
                            before = {"named": named, "size": got[0], "place": got[1], "rule": got[2].text, "action": got[2].action}
                hosts.append(host)
                paths.append(path)
                found.append(before)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page_id"), column(batch, "url"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(found, pa.struct([("named", pa.bool_()), ("size", pa.int64()), ("place", pa.int64()), ("rule", pa.string()), ("action", pa.string())]))],
                names=["page_id", "url", "host", "path", "best"])

    return pages.mapInArrow(apply, STATE)


def url_filter(pages: DataFrame, rules=RULES, patterns=PATTERNS, part_rules: int = PART_RULES) -> DataFrame:
    """page_id, host, path, rule (of ``rules``) and verdict: the rule's, else that of ``patterns``, else allow."""
    every = list(enumerate((*rules, *patterns)))
    counts = token_counts(pages, set().union(*(r.tokens() for _, r in every)))
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.lit(None).cast("string").alias("host"),
                       F.lit(None).cast("string").alias("path"), F.lit(None).cast(BEST).alias("best"))
    for lo in range(0, max(1, len(every)), part_rules):
        out = _best(stored(out, "judged") if lo else out, every[lo:lo + part_rules], len(rules), counts)
    return out.select("page_id", "host", "path", F.when(F.col("best.named"), F.col("best.rule")).alias("rule"),
                      F.coalesce("best.action", F.lit("allow")).alias("verdict"))
