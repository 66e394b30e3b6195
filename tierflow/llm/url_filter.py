"""URL filters: all glob rules simulated at once over each canonical URL.

Every rule is a glob over the canonical URL ``.host/path``. The states of all globs (how much of
each is matched) are bits of one long mask, packed into 64-bit words. A byte of the URL moves them
by Shift-And: a state steps on if the next symbol of its glob takes the byte, with a carry between
words, and stays where a wildcard takes it. A rule matches if its last state is set at the end.

Cost: one step per byte of a URL and word of the masks; URLs are moved together, those of a batch
as one array, so that a long URL costs its own length only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict for the URLs that a glob matches; ``name`` is what a result calls the rule.

    ``*`` is any run without a slash, ``**`` any run, ``?`` one character but a slash; all else
    stands for itself.
    """

    verdict: str
    glob: str
    name: str


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host and its subdomains, for paths that begin with ``path``."""
    return Rule(verdict, f"*.{host}{path}**", host + path)


def glob_rule(verdict: str, glob: str) -> Rule:
    return Rule(verdict, glob, glob)


# The rules of the query, which go before all globs.
HOST_RULES = (
    host_rule(ALLOW, "org", "/"),
    host_rule(BLOCK, "example.org", "/es/"),
    host_rule(BLOCK, "example.org", "/en/1"),
    host_rule(ALLOW, "com", "/fr/"),
    host_rule(BLOCK, "com", "/de/"),
)

# Hosts of link farms, betting and adult pages, and files that are no pages.
GLOBS = tuple(glob_rule(BLOCK, glob) for glob in (
    "*.spam-farm.**", "*.casino-**", "*.free-bets.**", "*.poker-**", "*.xxx.**",
    "**/wp-login.php**", "**/cgi-bin/**", "**.exe", "**.zip", "**.iso", "**.apk"))

SLASH = ord("/")
# Bytes of a UTF-8 sequence behind its first.
_BEHIND = np.arange(256) >> 6 == 2


class Automaton:
    """The masks of some rules: ``match[c]`` has the states that byte c leads to, ``stay[c]`` those it keeps."""

    def __init__(self, globs: Sequence[str]):
        match, stay, self.rule_of, first = [], [], {}, []
        for rule, glob in enumerate(globs):
            first.append(len(match))
            match.append(np.zeros(256, bool))
            stay.append(np.zeros(256, bool))
            for symbol in _symbols(glob):
                if symbol == "**":
                    stay[-1][:] = True
                elif symbol == "*":
                    stay[-1] |= np.arange(256) != SLASH
                else:
                    takes, keeps = np.zeros(256, bool), np.zeros(256, bool)
                    if symbol == "?":
                        takes = ~_BEHIND & (np.arange(256) != SLASH)
                        keeps = _BEHIND.copy()  # the other bytes of the character
                    else:
                        takes[symbol] = True
                    match.append(takes)
                    stay.append(keeps)
            self.rule_of[len(match) - 1] = rule
        self.words = max(1, -(-len(match) // 64))
        self.match, self.stay = (_masks(np.array(bits, bool).reshape(-1, 256), self.words) for bits in (match, stay))
        self.first, self.last = (_mask(states, self.words) for states in (first, list(self.rule_of)))
        self.settled = np.bitwise_and.reduce(self.stay, axis=0) & self.last

    def run(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, rule) of all matches of strings in a buffer."""
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(-length, kind="stable")
        at, ascending = start[order], length[order][::-1]
        state = np.tile(self.first, (len(order), 1))
        for step in range(int(ascending[-1])):
            here = len(order) - int(np.searchsorted(ascending, step, side="right"))
            now = state[:here]
            if step % 32 == 31 and not (now & ~self.settled).any():
                break
            byte = raw[at[:here] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.match[byte]
            now &= self.stay[byte]
            now |= moved
        state &= self.last
        row, word = np.nonzero(state)
        held = np.unpackbits(np.ascontiguousarray(state[row, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(held)
        rule = np.array([self.rule_of[b] for b in (word[hit] * 64 + bit).tolist()], np.int64)
        return order[row[hit]], rule


def _symbols(glob: str) -> Iterator[str | int]:
    at = 0
    while at < len(glob):
        if glob[at] == "*":
            wide = glob.startswith("**", at)
            yield "**" if wide else "*"
            at += 2 if wide else 1
        else:
            yield from ["?"] if glob[at] == "?" else glob[at].encode("utf-8", "surrogatepass")
            at += 1


def _mask(states: Sequence[int], words: int) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[np.array(states, np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _masks(bits: np.ndarray, words: int) -> np.ndarray:
    """One mask for each byte, from a row of 256 bits for each state."""
    out = np.zeros((256, words * 64), np.uint8)
    out[:, :len(bits)] = bits.T
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


class Filter:
    """The rules in automata of up to ``states`` states, so that the masks in use stay small."""

    def __init__(self, rules: tuple[Rule, ...], states: int = 1 << 14):
        # later in this order wins: the longest name, then the one given first
        self.rank = np.empty(len(rules), np.int64)
        self.rank[sorted(range(len(rules)), key=lambda i: (len(rules[i].name), -i))] = np.arange(len(rules))
        self.by_rank = np.append(np.argsort(self.rank), -1)  # rank -1, none, is the last place
        self.blocks: list[tuple[int, Automaton]] = []
        begin = size = 0
        for i, rule in enumerate(rules):
            if size and size + len(rule.glob) + 1 > states:
                self.blocks.append((begin, Automaton([r.glob for r in rules[begin:i]])))
                begin, size = i, 0
            size += len(rule.glob) + 1
        self.blocks.append((begin, Automaton([r.glob for r in rules[begin:]])))

    @classmethod
    @cache
    def of(cls, rules: tuple[Rule, ...]) -> Filter:
        return cls(rules)

    def winners(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray, n_first: int) -> tuple[np.ndarray, np.ndarray]:
        """The winning rule of each string among the first ``n_first`` rules and among the others; -1 if none."""
        best = np.full((2, len(start)), -1, np.int64)
        for begin, automaton in self.blocks:
            rows = max(1, (1 << 20) // automaton.words)
            for at in range(0, len(start), rows):
                row, rule = automaton.run(raw, start[at:at + rows], length[at:at + rows])
                rule += begin
                for which, of in enumerate((rule < n_first, rule >= n_first)):
                    np.maximum.at(best[which], at + row[of], self.rank[rule[of]])
        return self.by_rank[best[0]], self.by_rank[best[1]]


def judge(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES, globs: Sequence[Rule] = GLOBS,
          otherwise: str = ALLOW) -> DataFrame:
    """The verdict on every url of ``pages``: page_id, host, path, rule, verdict, pattern.

    The host is what stands after the first ``://`` up to a slash, ``?``, ``#`` or the end, with A-Z
    lower-cased; the path what follows up to ``?``, ``#`` or the end. The longest of ``rules`` that
    matches decides; where none does, the longest of ``globs``; else ``otherwise``. Of rules of one
    length the first given wins. ``rule`` and ``pattern`` name the longest match of either kind, or null.

    A null url or one without ``://`` has an empty host and path; it is judged like any other. Rows
    are judged one by one: repeated ones, null ids and ties each give a row. Long urls are read
    whole. No row is lost and none is shuffled; other columns are ignored. The rules travel with the
    job: they are a parameter, not a table.
    """
    every = tuple(rules) + tuple(globs)
    n_first = len(rules)
    part = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract("url", part, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"),
                         F.coalesce(F.regexp_extract("url", part, 2), F.lit("")).alias("path"))
    text = [T.StructField(name, T.StringType()) for name in ("host", "path", "rule", "verdict", "pattern")]
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType), *text])

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        filters = Filter.of(every)
        names = pa.array([r.name for r in every], pa.string())
        verdicts = pa.array([r.verdict for r in every], pa.string())
        for batch in batches:
            hosts, paths = (batch.column(c).cast(pa.large_binary()) for c in ("host", "path"))
            url = pc.binary_join_element_wise(pa.scalar(b".", pa.large_binary()), hosts, paths, pa.scalar(b"", pa.large_binary()))
            edge = np.frombuffer(url.buffers()[1], np.int64)[url.offset:url.offset + len(url) + 1]
            data = url.buffers()[2]
            raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
            first, second = (pa.array(w, mask=w < 0) for w in filters.winners(raw, edge[:-1], np.diff(edge), n_first))
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("host"), batch.column("path"), names.take(first),
                pc.coalesce(verdicts.take(first), verdicts.take(second), pa.scalar(otherwise)), names.take(second),
            ], names=schema.fieldNames())

    return parts.mapInArrow(rows, schema)
