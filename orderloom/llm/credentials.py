"""Operator 7: secrets, and credentials whose parts stand apart.

Strong findings (assignments, access identifiers, long hexadecimal runs) count by themselves. Weak
candidates (a bare string of the form of a secret key, an address of a service, an account number)
count only when complementary parts lie in the same scope: an interval join of candidates, done
within each document by one sweep over sorted places, so that no pair of candidates is spelled out.
A scope is a block of lines between blank lines, however long; with `reach`, parts in one scope also
have to lie within so many code points.

No shuffle: a document is judged where it is read.

Defined cases: null text is empty and has no spans. Repeated rows are judged each. Very many
candidates in one long text cost a sort and a binary search each. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame

from orderloom.llm.common import columns, per_slice

ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
#: Runs are as long as they can be, so a run of 24 or more is never part of a shorter match.
HEX = re.compile("[0-9a-f]{24,}")
#: Weak candidates. A key string has both cases and a digit, and stands between other characters.
KEY_STRING = re.compile("(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])")
SERVICES = ("s3", "sqs", "sns", "ec2", "rds", "dynamodb")
ENDPOINT = re.compile(
    "\\b(?:https?|amqps?|redis|mongodb|postgres(?:ql)?|mysql|s3)://[A-Za-z0-9.-]+(?::[0-9]{2,5})?"
    f"|(?<![A-Za-z0-9_-])[a-z0-9-]+\\.(?:{'|'.join(SERVICES)})\\.[a-z0-9.-]+", re.ASCII)
ACCOUNT = re.compile("(?<![0-9A-Za-z])[0-9]{12}(?![0-9A-Za-z])")
KINDS = ("assign", "access", "hex", "key", "endpoint", "account")
#: What completes a weak candidate: one of these kinds in its scope.
COMPLEMENTS = {"key": ("access", "account"), "account": ("access", "key"),
               "endpoint": ("access", "assign", "key")}
RESULT = columns("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint,"
                 "base_sha256 string, spans string, n_linked bigint, links strings")
BLANK = re.compile("\n[ \t\r]*\n")
Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates that overlap no base span."""
    found = [(*m.span(), "key") for m in KEY_STRING.finditer(text)
             if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])]
    if "://" in text or any(f".{s}." in text for s in SERVICES):
        found += [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    found += [(*m.span(), "account") for m in ACCOUNT.finditer(text)]
    ends = []  # furthest end of the base spans up to each
    for _, end, _ in base:
        ends.append(max(end, ends[-1] if ends else 0))
    starts = [s for s, _, _ in base]
    def free(span: Span) -> bool:
        i = bisect_left(starts, span[1])
        return not i or ends[i - 1] <= span[0]
    return sorted(s for s in found if free(s))


def linked(text: str, base: list[Span], reach: int | None = None) -> tuple[list[Span], list[str]]:
    """Weak spans with a complement in scope, and one link for each: to the nearest complement.

    Three sweeps: key strings against identifiers first; then what else is weak against the base
    spans and the key strings just reported.
    """
    weak = weak_spans(text, base)
    if not weak:
        return [], []
    borders = [m.start() for m in BLANK.finditer(text)]
    scope = lambda place: bisect_right(borders, place)
    reported: list[Span] = []
    links: list[str] = []

    def sweep(kind: str, others: list[Span]) -> None:
        others = sorted(others)
        starts = [s for s, _, _ in others]
        for span in (s for s in weak if s[2] == kind):
            i = bisect_left(starts, span[0])
            near = [(max(o[0] - span[1], span[0] - o[1], 0), o) for o in others[max(0, i - 1):i + 1]
                    if scope(o[0]) == scope(span[0])]
            near = [x for x in near if reach is None or x[0] <= reach]
            if near:
                other = min(near)[1]
                reported.append(span)
                links.append(f"{kind}:{span[0]}:{span[1]}>{other[2]}:{other[0]}:{other[1]}")

    # An address alone does not make a key string: identifiers only.
    sweep("key", [s for s in base + weak if s[2] in COMPLEMENTS["key"]])
    keys = [s for s in reported if s[2] == "key"]
    sweep("account", [s for s in base if s[2] in COMPLEMENTS["account"]] + keys)
    sweep("endpoint", [s for s in base if s[2] in COMPLEMENTS["endpoint"]] + keys)
    return reported, links


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in
                    sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def judge(text: str | None, reach: int | None = None) -> tuple:
    text = text or ""
    base = base_spans(text)
    more, links = linked(text, base, reach)
    kinds = [k for _, _, k in base]
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
            hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more), links)


def secret_scan(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """One row per document: counts of base findings, all spans, and the links of weak ones."""

    def task(part: dict[str, list]) -> dict[str, list]:
        rows = [(d, *judge(t, reach)) for d, t in zip(part["doc_id"], part["text"], strict=True)]
        return dict(zip(RESULT.names, map(list, zip(*rows, strict=True)), strict=True))

    return per_slice(docs.select("doc_id", "text"), task, RESULT)
