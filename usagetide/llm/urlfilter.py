"""Glob rules over URLs, matched together by one bit-parallel automaton.

Every pattern becomes a run of states, one bit each, packed into 64-bit words that patterns
may straddle. Reading a character moves all patterns at once (Shift-And):

    D = ((D << 1) & reach[c]) | (D & stay[c])

``reach[c]`` has the states that may be entered by ``c``, ``stay[c]`` those that a star lets
wait. After the last character the accepting bits say which patterns match. All URLs of a
batch advance in step, longest first; the few that are longer than the others end one at a time,
with the same masks as whole numbers, which is cheaper than a step of arrays for each byte.

Patterns are matched against the canonical form ``.host`` + SEPARATOR + ``path``. ``?`` is any
byte, ``*`` any run of bytes; before the separator both stop at it, so a pattern for hosts never
reaches into a path. Canonical URLs are UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text as T

SEPARATOR = "\x01"
#: URLs that must be left for a step over arrays; fewer go on one at a time.
IN_STEP = 48
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Glob:
    """A pattern over the canonical URL, its verdict, its rank (the highest match wins) and its name, if shown."""

    pattern: str
    verdict: str
    rank: int
    name: str | None = None


def site_rule(rule: str, verdict: str) -> Glob:
    """``host/path``: the host and its subdomains, with paths that start with ``/path``; longer rules win.

    Characters that globs give a meaning are taken literally.
    """
    host, _, path = rule.partition("/")
    plain = "".join(f"\\{c}" if c in "*?\\" else c for c in f".{host}{SEPARATOR}/{path}")
    return Glob(f"*{plain}*", verdict, 1_000_000 + len(rule), rule)


def glob_rule(host: str, path: str, verdict: str, rank: int = 0) -> Glob:
    """A glob for the host and one for the path."""
    return Glob(f".{host}{SEPARATOR}{path}", verdict, rank)


class Automaton:
    """All patterns of a rule list as Shift-And masks."""

    def __init__(self, patterns: Sequence[str]) -> None:
        reach: list[set[int]] = []
        stay: list[set[int]] = []
        self.first, self.last = [], []
        for p in patterns:
            everything = set(range(256))
            host = SEPARATOR in p
            alphabet = everything - {ord(SEPARATOR)} if host else everything
            self.first.append(len(reach))
            reach.append(set())  # the start state is never entered
            stay.append(set())
            data, i = p.encode(), 0
            while i < len(data):
                c = data[i]
                if c == ord("*"):
                    stay[-1] |= alphabet
                elif c == ord("?"):
                    reach.append(set(alphabet))
                    stay.append(set())
                else:
                    if c == ord("\\") and i + 1 < len(data):
                        i += 1
                        c = data[i]
                    if c == ord(SEPARATOR):
                        alphabet = everything
                    reach.append({c})
                    stay.append(set())
                i += 1
            self.last.append(len(reach) - 1)
        self.words = max(1, -(-len(reach) // 64))
        self.reach = self._pack(reach)
        self.stay = self._pack(stay)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for s in self.first:
            self.start[s // 64] |= np.uint64(1) << np.uint64(s % 64)
        self.numbers = [(self._number(r), self._number(w)) for r, w in zip(self.reach, self.stay)]

    @staticmethod
    def _number(mask: np.ndarray) -> int:
        return int.from_bytes(mask.astype("<u8").tobytes(), "little")

    def _finish(self, state: np.ndarray, rest: bytes) -> np.ndarray:
        """The state after all of ``rest``."""
        now, masks = self._number(state), self.numbers
        for c in rest:
            reach, stay = masks[c]
            now = ((now << 1) & reach) | (now & stay)
        return np.frombuffer(now.to_bytes(8 * self.words, "little"), dtype="<u8").astype(np.uint64)

    def _pack(self, states: list[set[int]]) -> np.ndarray:
        masks = np.zeros((256, self.words), dtype=np.uint64)
        for s, chars in enumerate(states):
            masks[sorted(chars), s // 64] |= np.uint64(1) << np.uint64(s % 64)
        return masks

    def match(self, urls: list[bytes]) -> np.ndarray:
        """Boolean matrix: URL by pattern."""
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(urls) or b"\0", dtype=np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        for step in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-sizes, -step, side="left"))  # sizes > step
            if live < IN_STEP:
                for k in range(live):
                    state[k] = self._finish(state[k], urls[order[k]][step:])
                break
            now = state[:live]
            c = flat[begin[:live] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.reach[c]) | (now & self.stay[c])
        found = np.empty((len(urls), len(self.last)), dtype=bool)
        for k, s in enumerate(self.last):
            found[order, k] = (state[:, s // 64] >> np.uint64(s % 64)) & np.uint64(1) == 1
        return found


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; null or no ``://``: empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: str) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(whole, "://")
    return F.when(at > 0, F.substr(whole, at + F.lit(3))).otherwise(F.lit(""))


def canonical(url: str) -> Column:
    """The form that patterns read; a SEPARATOR inside the URL becomes ``%01``."""
    def clean(part: Column) -> Column:
        return F.replace(part, F.lit(SEPARATOR), F.lit("%01"))

    return F.concat(F.lit("."), clean(host(url)), F.lit(SEPARATOR), clean(path(url)))


def judge(
    pages: DataFrame,
    rules: Sequence[Glob],
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
    default: str = "allow",
    no_host: str = "block",
) -> DataFrame:
    """The columns ``keep``, ``host``, ``path``, ``rule`` (name of the winning rule, if it has one) and ``verdict``.

    The highest rank wins, then the later rule. Without a match the verdict is ``default``, or
    ``no_host`` where the URL has no host (null, empty or no ``://``). Other columns of ``pages``
    are not read; one row comes out for each row that goes in. Rules are part of the program, so
    their number does not depend on the data.
    """
    ranked = sorted(range(len(rules)), key=lambda k: (rules[k].rank, k))
    ordered = [rules[k] for k in ranked]
    automaton = Automaton([r.pattern for r in ordered])
    slim = pages.select(*keep, host(url).alias("host"), path(url).alias("path"), canonical(url).cast("binary").alias("canonical"))
    names = slim.columns[:-1]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, urls in T.buffers(batch.column(batch.num_columns - 1)):
            found = automaton.match(urls)
            best = np.where(found.any(axis=1), found.shape[1] - 1 - np.argmax(found[:, ::-1], axis=1), -1) if ordered else np.full(len(urls), -1)
            kept = [batch.column(i).slice(first, len(urls)) for i in range(len(names))]
            named = [ordered[k].name if k >= 0 else None for k in best]
            said = [ordered[k].verdict if k >= 0 else None for k in best]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(named, pa.string()), pa.array(said, pa.string())], names=[*names, "rule", "said"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    judged = T.map_batches(slim, work, ", ".join([*fields, "rule string", "said string"]))
    fallback = F.when(F.col("host") == "", F.lit(no_host)).otherwise(F.lit(default))
    return judged.select(*names, "rule", F.coalesce("said", fallback).alias("verdict"))
