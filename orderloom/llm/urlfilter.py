"""Operator 8: URL rules as one bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL `.host/path?query`: `*` is any run without `/`, `**` any
run, `?` one character but `/`. The leading point makes `*.example.org/**` fit the host itself and
all its subdomains. With an empty path nothing parts host and query, so the leading run of a host
rule stops at `?` as well; in any other glob a `*` may go on into such a query. All globs are packed side by side into masks of as many 64-bit words as they
need. A step of the Shift-And automaton reads one character of each URL of a batch and moves all
states of all globs at once, with self-loops for the wildcards:

    D = ((D << 1) & reads[c]) | (D & loops[c])

A glob fits if its last state is set after the last character. Of the rules that fit, the one of
highest rank (as a rule: the longest) decides.

No shuffle; the rules travel with the task and are as long as what the user wrote.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule, and gets
the default verdict. Empty hosts or paths are matched as they are. Repeated rows are judged each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from orderloom.llm.common import columns, per_slice, worker_memory

URL = re.compile("(?s).*?://([^/?#]*)([^?#]*)(\\?[^#]*)?")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RESULT = columns("page_id bigint, host string, path string, rule string, verdict string,"
                 "glob string")
Token = tuple[str, str]


@dataclass(frozen=True)
class Rule:
    """`glob` over the canonical URL; the fitting rule of highest rank gives the verdict."""

    glob: str
    verdict: str
    name: str | None = None
    rank: int = 0
    #: Whether the leading `*` stays in the host.
    host: bool = False


def host_rule(verdict: str, name: str) -> Rule:
    """A rule like `example.org/fr/`: the host and its subdomains, and what their paths start with.

    Any host rule outranks any other glob; among themselves, the longest wins.
    """
    literal = re.sub("([*?\\\\])", "\\\\\\1", name)
    return Rule(f"*.{literal}**", verdict, name, 1_000_000 + len(name), host=True)


def parts_of(url: str | None) -> tuple[str, str, str]:
    """Host, path and query with its question mark."""
    found = URL.match(url or "")
    if not found:
        return "", "", ""
    return found[1].translate(LOWER), found[2], found[3] or ""


def tokens(glob: str) -> list[Token]:
    """("char", c), ("one", "") and ("run", "/" or ""): the run's excluded characters."""
    found: list[Token] = []
    at = 0
    while at < len(glob):
        if glob[at] == "\\" and at + 1 < len(glob):
            found.append(("char", glob[at + 1]))
            at += 2
        elif glob.startswith("**", at):
            found.append(("run", ""))
            at += 2
        else:
            c = glob[at]
            found.append(("run", "/") if c == "*" else ("one", "") if c == "?" else ("char", c))
            at += 1
    return found


class Automaton:
    """Masks of all rules. A glob of n characters has n + 1 states, next to each other."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = sorted(rules, key=lambda r: -r.rank)
        parsed = [tokens(r.glob) for r in self.rules]
        for rule, ts in zip(self.rules, parsed, strict=True):
            if rule.host and ts[:1] == [("run", "/")]:
                ts[0] = ("run", "/?")
        alphabet = sorted({c for ts in parsed for kind, c in ts if kind == "char"} | {"/", "?"})
        #: Class 0 is every character that no rule names.
        self.letters = np.array([ord(c) for c in alphabet], "u4")
        size = sum(1 + sum(kind != "run" for kind, _ in ts) for ts in parsed)
        self.words = max(1, -(-size // 64))
        classes = len(alphabet) + 1
        slash = alphabet.index("/") + 1
        reads, loops = np.zeros((classes, size), bool), np.zeros((classes, size), bool)
        start, self.last, state = np.zeros(size, bool), [], -1
        for ts in parsed:
            state += 1
            start[state] = True
            for kind, c in ts:
                if kind == "run":  # the state before the run stays while the run goes on
                    loops[:, state] = True
                    if c and not self._any_run(ts, state, start):
                        loops[[alphabet.index(x) + 1 for x in c], state] = False
                else:
                    state += 1
                    if kind == "char":
                        reads[alphabet.index(c) + 1, state] = True
                    else:
                        reads[:, state] = True
                        reads[slash, state] = False
            self.last.append(state)
        self.reads, self.loops = self._packed(reads), self._packed(loops)
        self.start = self._packed(start[None, :])[0]
        self.final = self._packed(np.isin(np.arange(size), self.last)[None, :])[0]

    @staticmethod
    def _any_run(ts: list[Token], state: int, start: np.ndarray) -> bool:
        """Whether `**` also stands at this state, as in `***`."""
        at = int(np.flatnonzero(start[:state + 1])[-1])
        for kind, c in ts:
            if kind != "run":
                at += 1
            elif at == state and c == "":
                return True
        return False

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((bits.shape[0], self.words * 64), bool)
        wide[:, :bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view("<u8")

    def first_fit(self, urls: list[str]) -> list[Rule | None]:
        """The rule of highest rank that fits each URL."""
        if not self.rules or not urls:
            return [None] * len(urls)
        lengths = np.array([len(u) for u in urls])
        order = np.argsort(-lengths, kind="stable")
        steps = lengths[order]
        points = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), "<u4")
        place = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(place, len(self.letters) - 1)] == points
        kinds = np.where(known, place + 1, 0)
        begin = (np.cumsum(lengths) - lengths)[order]
        d = np.repeat(self.start[None, :], len(urls), axis=0)
        for i in range(int(steps[0])):
            n = int(np.searchsorted(-steps, -i, side="left"))  # URLs longer than i come first
            now, c = d[:n], kinds[begin[:n] + i]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)  # carry into the next word
            d[:n] = (moved & self.reads[c]) | (now & self.loops[c])
        fits: list[Rule | None] = [None] * len(urls)
        ended = np.flatnonzero((d & self.final).any(axis=1))
        if len(ended):
            bits = np.unpackbits(d[ended].view("u1"), axis=1, bitorder="little")[:, self.last]
            for row, rule in zip(ended, bits.argmax(axis=1), strict=True):
                fits[order[row]] = self.rules[rule]
        return fits


def url_filter(pages: DataFrame, rules: tuple[Rule, ...], default: str = "allow",
               key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule (the name of the rule, or null), verdict, glob."""

    def task(part: dict[str, list]) -> dict[str, list]:
        made = worker_memory("urlfilter")
        if rules not in made:  # once per Python worker
            made.clear()
            made[rules] = Automaton(rules)
        split = [parts_of(u) for u in part["url"]]
        fits = made[rules].first_fit(
            [f".{h}{p}{q}" if h or p else "" for h, p, q in split])
        return {"page_id": part[key], "host": [s[0] for s in split], "path": [s[1] for s in split],
                "rule": [r and r.name for r in fits],
                "verdict": [r.verdict if r else default for r in fits],
                "glob": [r and r.glob for r in fits]}

    return per_slice(pages.select(key, "url"), task, RESULT, rows=4096)


#: The query's rules, and globs of pages without text worth keeping.
RULES = (
    host_rule("block", "net/"), host_rule("allow", "example.net/en/"),
    host_rule("block", "example.com/de/"), host_rule("allow", "org/fr/"),
    Rule("**/wp-login**", "block"), Rule("**/cart/**", "block"), Rule("**/checkout/**", "block"),
    Rule("**.exe", "block"), Rule("**.zip", "block"), Rule("*.doubleclick.*/**", "block"),
)
