"""URL filters: all glob rules at once, by a bit-parallel automaton.

Every rule is a glob over the canonical form of a URL, ``.host/path`` behind
a dot, so that a rule for a host also fits its subdomains. ``*`` stands for any run of
characters without ``/`` and so stays inside the host, ``**`` for any run at
all. Each rule takes one bit for each of its characters, and the
bits of all rules lie in one row of 64-bit words. Reading a character shifts the whole row by
one and masks it (Shift-And); a second mask keeps the bits at which a wildcard loops. All
URLs of a batch advance together, one row of words each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, map_columns, text_bytes

#: Rules of the contract: verdict, host and path.
SITE_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Globs for what no site rule decides: hosts and pages of betting, adult and download spam.
BLOCKED_GLOBS = (
    ".*free-bets*/**",
    ".*casino*/**",
    ".*poker*/**",
    ".*porn*/**",
    ".*xxx*/**",
    ".*adult-*/**",
    ".*warez*/**",
    ".*cheap-pills*/**",
    ".*/**download-free**",
    ".*/**.exe",
)

#: Bytes of canonical URLs that advance together.
BATCH = 4096


@dataclass(frozen=True)
class Rule:
    verdict: str
    glob: str
    name: str | None = None

    @property
    def weight(self) -> int:
        """Longer site rules win over shorter ones, and these over globs."""
        return len(self.name) if self.name else -1


def site_rule(verdict: str, host: str, path: str) -> Rule:
    return Rule(verdict, f".*{host}{path}**" if not host else f"*.{host}{path}**", f"{host}{path}")


RULES = tuple(site_rule(*r) for r in SITE_RULES) + tuple(Rule("block", g) for g in BLOCKED_GLOBS)


def canonical(url: str | None) -> tuple[str, str]:
    """Host, with A-Z in lower case, and path; both empty for null and without ``://``."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


class Automaton:
    """Shift-And masks of many globs, packed into 64-bit words.

    A rule's bits: one for its start, then one for each literal byte. Bit k
    set means that the pattern up to its k-th literal has been read. A
    wildcard between two literals keeps the bit before it set.
    """

    def __init__(self, globs: list[str]):
        loops, literals, starts, finals = [], [], [], []
        for glob in globs:
            starts.append(len(literals))
            literals.append(None)
            loops.append("")
            data = text_bytes(glob)
            i = 0
            while i < len(data):
                if data[i : i + 1] == b"*":
                    double = data[i : i + 2] == b"**"
                    loops[-1] = "**" if double or loops[-1] == "**" else "*"
                    i += 1 + double
                else:
                    literals.append(data[i])
                    loops.append("")
                    i += 1
            finals.append(len(literals) - 1)
        self.words = (len(literals) + 63) // 64 or 1
        self.finals = np.array(finals, dtype=np.int64)
        self.initial = self._packed(starts)
        self.step = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        any_ = self._packed([k for k, kind in enumerate(loops) if kind == "**"])
        host = self._packed([k for k, kind in enumerate(loops) if kind])
        for byte in range(256):
            self.step[byte] = self._packed([k for k, literal in enumerate(literals) if literal == byte])
            self.stay[byte] = any_ if byte == ord("/") else host

    def _packed(self, bits: list[int]) -> np.ndarray:
        row = np.zeros(self.words, dtype=np.uint64)
        for bit in bits:
            row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return row

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Which globs fit which whole text: a row for each text."""
        lengths = np.array(list(map(len, texts)), dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        state = np.tile(self.initial, (len(texts), 1))
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        offsets = (np.cumsum(lengths) - lengths)[order]
        sorted_lengths = lengths[order]
        for at in range(longest):
            # Longest first: the texts that still have a byte are a prefix.
            active = int(np.searchsorted(-sorted_lengths, -at, side="left"))
            bytes_ = data[offsets[:active] + at]
            now = state[:active]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (shifted & self.step[bytes_]) | (now & self.stay[bytes_])
        ends = (state[:, self.finals // 64] >> (self.finals % 64).astype(np.uint64)) & np.uint64(1)
        out = np.empty(ends.shape, dtype=bool)
        out[order] = ends.astype(bool)
        return out


RESULT = T.StructType(
    [
        T.StructField("host", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType(), False),
        T.StructField("glob", T.StringType()),
    ]
)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Verdict on each row's ``url``: the ``keep`` columns, host, path, rule, verdict, and the glob that decided.

    Of the site rules that fit, the longest wins, the first of equal length;
    without one, the first fitting glob; without any, the URL is allowed. ``rule`` is
    the site rule, else null; ``glob`` is what decided, null if nothing fits.

    Null, empty and schemeless URLs have an empty host and path, fit no site rule and
    are allowed. Bytes above ASCII are compared as they are. URLs of any length are
    read whole. Repeated rows give repeated results, an empty table an
    empty one; other columns are ignored. One pass, no shuffle.
    """
    schema = T.StructType([pages.schema[c] for c in keep] + RESULT.fields)
    ranked = sorted(rules, key=lambda r: -r.weight)

    def judged(batches: Iterator[Columns]) -> Iterator[Columns]:
        automaton = Automaton([r.glob for r in ranked])
        for batch in batches:
            parts = list(map(canonical, batch["url"]))
            decided: list[Rule | None] = []
            for start in range(0, len(parts), BATCH):
                fits = automaton.matches([text_bytes(f".{host}{path}") for host, path in parts[start : start + BATCH]])
                first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
                decided.extend(ranked[k] if k >= 0 else None for k in first.tolist())
            yield {name: batch[name] for name in keep} | {
                "host": [host for host, _ in parts],
                "path": [path for _, path in parts],
                "rule": [r.name if r else None for r in decided],
                "verdict": [r.verdict if r else "allow" for r in decided],
                "glob": [r.glob if r else None for r in decided],
            }

    return map_columns(pages.select(*dict.fromkeys([*keep, "url"])), schema, judged)
