"""Secret scan with linking of credential parts.

Strong patterns report a secret by themselves. Parts that are too weak for that (a short assigned
value, a mixed token without a keyword, a user name, an address) are reported only when parts of
a complementary role lie near them in the same scope: a secret beside an identifier or endpoint.
Parts of different roles may overlap, as where an address holds a token.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import map_rows

# Fixed values of the contract: patterns and least lengths of the strong kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
ACCESS_LENGTH = 18

# Weak kinds.
WEAK_VALUE_LENGTH = 6
WEAK_ACCESS_LENGTH = 16
IDENTIFIER = re.compile(
    r"""(?:user_?name|user_?id|user|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]"""
    r"""\x20*["']?[A-Za-z0-9+/_.@-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(
    r"""(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""
    r"""|(?:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?""",
    re.IGNORECASE | re.ASCII,
)
BARE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
SCOPE_BREAK = re.compile(r"\n[ \t\r]*\n")
MAX_GAP = 300

KINDS = ("assign", "access", "hex", "weak_secret", "weak_identifier", "endpoint")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}
_SECRETS = {"assign", "hex", "weak_secret"}
_PARTNERS = {"access", "weak_identifier", "endpoint"}
# Parts overlap others of their own role only if one of them goes.
_ROLE = dict.fromkeys(_SECRETS, "secret") | {
    "access": "identifier", "weak_identifier": "identifier", "endpoint": "endpoint"
}

Span = tuple[str, int, int]


def strong_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the strong kinds, and the assignments and access identifiers too short for that."""
    strong, short = [], []
    for m in ASSIGN.finditer(text):
        length = m.end(2) - m.start(2)
        if length >= ASSIGN_LENGTH:
            strong.append(("assign", m.start(), m.end()))
        elif length >= WEAK_VALUE_LENGTH:
            short.append(("weak_secret", m.start(), m.end()))
    for m in ACCESS.finditer(text):
        length = m.end() - m.start()
        if length >= ACCESS_LENGTH:
            strong.append(("access", m.start(), m.end()))
        elif length >= WEAK_ACCESS_LENGTH:
            short.append(("weak_identifier", m.start(), m.end()))
    strong += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return strong, short


def _mixed(token: str) -> bool:
    return (
        any(c.isdigit() for c in token)
        and any(c.islower() for c in token)
        and any(c.isupper() for c in token)
    )


class _Places:
    """Spans, and whether one of them touches a place."""

    def __init__(self, spans: list[Span]):
        taken = sorted((start, end) for _, start, end in spans)
        self.starts = [start for start, _ in taken]
        self.last_end = list(accumulate((end for _, end in taken), max))

    def touch(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, end - 1)
        return before > 0 and self.last_end[before - 1] > start


def weak_parts(text: str, strong: list[Span], short: list[Span]) -> list[Span]:
    """Weak parts that no strong span and no earlier weak part of their role touches.

    A token without a keyword that touches an identifier or a named host is that part's value.
    """
    named = [("weak_identifier", m.start(), m.end()) for m in IDENTIFIER.finditer(text)]
    endpoints = [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    hosts = [e for e in endpoints if "://" not in text[e[1] : e[2]]]
    identifiers = [part for part in [*strong, *short, *named] if _ROLE[part[0]] == "identifier"]
    valued = _Places([*identifiers, *hosts])
    found = [*short, *named, *endpoints]
    found += [
        ("weak_secret", m.start(), m.end())
        for m in BARE.finditer(text)
        if _mixed(m.group()) and not valued.touch(m.start(), m.end())
    ]
    by_role = {r: _Places([s for s in strong if _ROLE[s[0]] == r]) for r in set(_ROLE.values())}
    kept, ends = [], dict.fromkeys(by_role, -1)
    for kind, start, end in sorted(found, key=lambda s: (s[1], _ORDER[s[0]], s[2])):
        role = _ROLE[kind]
        if ends[role] > start or by_role[role].touch(start, end):
            continue
        ends[role] = end
        kept.append((kind, start, end))
    return kept


def linked(parts: list[Span], breaks: list[int], max_gap: int) -> set[Span]:
    """Parts with a complementary part at most ``max_gap`` characters away in their own scope.

    An interval join that only asks whether a partner exists: per scope, of the partners that
    start before a part's reach the one that ends last decides, so a text with n parts costs
    n log n and no pairs are built.
    """
    scopes: dict[int, list[Span]] = {}
    for part in parts:
        scopes.setdefault(bisect_right(breaks, part[1]), []).append(part)
    out = set()
    for members in scopes.values():
        for own, other in ((_SECRETS, _PARTNERS), (_PARTNERS, _SECRETS)):
            partners = sorted((s, e) for kind, s, e in members if kind in other)
            starts = [s for s, _ in partners]
            last_end = list(accumulate((e for _, e in partners), max))
            for kind, start, end in members:
                if kind in own:
                    reach = bisect_right(starts, end + max_gap)
                    if reach and last_end[reach - 1] >= start - max_gap:
                        out.add((kind, start, end))
    return out


def scan_text(text: str | None, max_gap: int = MAX_GAP) -> tuple[list[Span], list[Span]]:
    """Strong spans, and the weak parts that are linked; each by start, kind and end."""
    text = text or ""
    strong, short = strong_spans(text)
    weak = weak_parts(text, strong, short)
    if weak:
        breaks = [m.end() for m in SCOPE_BREAK.finditer(text)]
        found = linked([*strong, *weak], breaks, max_gap)
        weak = [part for part in weak if part in found]
    by_place = lambda s: (s[1], _ORDER[s[0]], s[2])
    return sorted(strong, key=by_place), sorted(weak, key=by_place)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_gap: int = MAX_GAP
) -> DataFrame:
    """One row per input row: ``doc_id``, ``strong`` and ``linked`` spans (code points, end
    exclusive).

    A scope is a block between blank lines. Everything stays in the row's task: the parts of a
    text are joined where the text is, so no key can be hot and nothing is shuffled. Null texts
    count as empty, empty ones have no spans, repeated rows give repeated results, an empty table
    gives an empty one, and other columns, whatever their names, are not read.
    """

    def start():
        def one(value):
            return tuple(
                [{"kind": k, "start": a, "end": b} for k, a, b in spans]
                for spans in scan_text(value, max_gap)
            )

        return one

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_rows(narrow, ["doc_id"], ["text"], f"strong {_SPANS}, linked {_SPANS}", start)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_digest(scanned: DataFrame) -> DataFrame:
    """Counts and digest of the strong spans, and all spans as one string."""
    count = lambda kind: F.size(
        F.filter("strong", lambda s: s["kind"] == kind)
    ).cast("bigint")
    rank = F.array(*[F.lit(k) for k in KINDS])
    in_order = F.transform(
        F.array_sort(
            F.transform(
                F.concat("strong", "linked"),
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.array_position(rank, s["kind"]).alias("rank"),
                    s["end"].alias("end"),
                    s["kind"].alias("kind"),
                ),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("strong")), 256).alias("base_sha256"),
        _joined(in_order).alias("spans"),
    )

