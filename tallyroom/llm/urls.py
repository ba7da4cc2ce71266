"""URL filters: glob rules as one bit-parallel wildcard automaton.

All rules are packed side by side into the bits of a few 64-bit words (Shift-And). A bit is a place in a
rule; reading a character moves every place on at once, `*` keeps its place alive, and the words pass
their carry on. Many URLs are read at once, one character of each per step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands between host and path; no character of a text has this number.
BORDER = 0x110000
ROWS_AT_ONCE = 8192


@dataclass(frozen=True)
class Rule:
    """A rule for a host and all its subdomains, and paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query, as its contract states them.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: What no rule fits is blocked by these globs over host and path, and allowed otherwise.
GLOBS = ("*/wp-admin/*", "*/wp-login.php*", "*/cgi-bin/*", "*/login/*", "*/logout/*", "*/cart/*", "*.exe", "*.zip", "*.iso", "*//*//*")


class WildcardAutomaton:
    """Globs (`*` any run, `?` any one character) over sequences of numbers, matched as a whole.

    A pattern is a list of code points, `"*"` and `"?"`. `matches` gives one row per text and one column
    per pattern.
    """

    def __init__(self, patterns: list[list[int | str]]):
        letters: dict[int, int] = {}
        places: list[tuple[int | str, bool, bool]] = []  # symbol, a star follows, first of its pattern
        self.open: list[tuple[bool, int]] = []  # begins with a star, last place (-1: none)
        starts: list[bool] = []
        for pattern in patterns:
            symbols = [s for s in pattern if s != "*"]
            stars = [False] * (len(symbols) + 1)
            n = 0
            for s in pattern:
                if s == "*":
                    stars[n] = True
                else:
                    n += 1
            for i, s in enumerate(symbols):
                if s != "?":
                    letters.setdefault(s, len(letters) + 1)
                places.append((s, stars[i + 1], i == 0))
                starts.append(i == 0 and stars[0])
            self.open.append((stars[0], len(places) - 1 if symbols else -1))
        words = max(1, -(-len(places) // 64))
        self.letters = np.array(sorted(letters), np.int64)
        self.classes = np.array([letters[x] for x in sorted(letters)], np.int64)
        self.table = np.zeros((len(letters) + 1, words), np.uint64)
        self.keep, self.first, self.again = (np.zeros(words, np.uint64) for _ in range(3))
        for i, (symbol, star, first) in enumerate(places):
            word, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
            self.table[slice(None) if symbol == "?" else letters[symbol], word] |= bit
            self.keep[word] |= bit if star else np.uint64(0)
            self.first[word] |= bit if first else np.uint64(0)
            self.again[word] |= bit if starts[i] else np.uint64(0)

    def matches(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For texts laid end to end in `codes`, text i up to ends[i]."""
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        lengths = ends - begins
        at = np.searchsorted(self.letters, codes)
        at[at == len(self.letters)] = 0
        known = self.letters[at] == codes if len(self.letters) else np.zeros(len(codes), bool)
        kind = np.where(known, self.classes[at], 0) if len(self.letters) else np.zeros(len(codes), np.int64)
        order = np.argsort(-lengths, kind="stable")
        by_length = lengths[order]
        state = np.zeros((len(ends), self.table.shape[1]), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(by_length[0]) if len(ends) else 0):
            live = order[: np.searchsorted(-by_length, -step, "left")]  # the texts longer than step
            now = state[live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= ~self.first
            moved |= self.first if step == 0 else self.again
            state[live] = (moved & self.table[kind[begins[live] + step]]) | (now & self.keep)
        out = np.zeros((len(ends), len(self.open)), bool)
        for i, (star, last) in enumerate(self.open):
            if last < 0:
                out[:, i] = star | (lengths == 0)
            else:
                out[:, i] = (state[:, last // 64] >> np.uint64(last % 64)) & one == one
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; the path
    goes on to `?`, `#` or the end. Both are empty without a `://`."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = re.split(r"[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), slash + path


def codes(text: str) -> list[int]:
    return [ord(c) for c in text]


def rule_glob(rule: Rule) -> list[int | str]:
    return ["*", *codes("." + rule.host), BORDER, *codes(rule.path), "*"]


def free_glob(glob: str) -> list[int | str]:
    """A glob over host and path as one text; its first `/` is where the path begins."""
    symbols: list[int | str] = [c if c in "*?" else ord(c) for c in glob]
    if ord("/") in symbols:
        at = symbols.index(ord("/"))
        return ["*", *symbols[:at], "*", *symbols[at:]] if symbols[:1] == ["*"] else [ord("."), *symbols[:at], BORDER, *symbols[at:]]
    return ["*", *symbols]


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, globs: tuple[str, ...] = GLOBS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest rule that fits decides; of equally long ones, the first named. Without one, the
    globs decide. A null or odd URL has an empty host and path; rules never fit it. Repeated rows are
    judged each, an empty table gives no rows, and other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    automaton = WildcardAutomaton([rule_glob(r) for r in ranked] + [free_glob(g) for g in globs])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(begin, ROWS_AT_ONCE)
                parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
                texts = [[ord("."), *codes(h), BORDER, *codes(p)] for h, p in parts]
                ends = np.cumsum([len(t) for t in texts])
                flat = np.fromiter((c for t in texts for c in t), np.int64, int(ends[-1]))
                hit = automaton.matches(flat, ends)
                ruled, n = hit[:, : len(ranked)], len(ranked)
                best = np.where(ruled.any(axis=1), ruled.argmax(axis=1), n) if n else np.zeros(len(batch), int)
                odd = hit[:, n:].any(axis=1)
                names, verdicts = [], []
                for i, b in enumerate(best):
                    names.append(ranked[b].name if b < n else None)
                    verdicts.append(ranked[b].verdict if b < n else "block" if odd[i] else "allow")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id").cast(pa.int64()), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(
        judge, "page_id long, host string, path string, rule string, verdict string"
    )
