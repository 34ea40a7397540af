"""Secret scans: fixed rules, and formats inferred from what these find.

The values that the rules find are credentials labelled by kind. From a bounded sample of them
one probabilistic automaton per kind is inferred, and one from strings of the same alphabet that
no rule labels. Every string of six or more characters of that alphabet outside the rules' spans is
a candidate; it is scored by the best log likelihood of its format under a kind's automaton, less
that as a plain string: under the plain strings' automaton, or as runs of any kind if that is more.
Candidates far enough above become spans of kind `format` besides those of the rules.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.automata import Automaton, any_string, shape
from folioforge.llm.common import fresh

KINDS = ("assign", "access", "hex", "format")
#: Strings of each kind that an automaton is inferred from, and plain ones.
SAMPLE = 500
PLAIN_SAMPLE = 2_000
#: Nats by which a candidate's format must be likelier as a credential.
MARGIN = 12.0
MASK = "[SECRET]"
#: Share of the plain sample up to which a format does not count as plain: unnamed secrets are in it, too.
_RARE = 1 / 400
# Strings whose margin a task remembers, and how long they may be.
_REMEMBERED = 100_000
_SHORT = 64
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Strings of the rules' value alphabet; a rule's value has six characters at least.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
_NAMES = ("password", "passwd", "secret", "token", "api")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the rules by start, then kind; an assignment's span includes its name."""
    low = text.lower()
    found = []
    if any(name in low for name in _NAMES):
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def labelled_values(text: str, spans: list[Span]) -> list[tuple[str, str]]:
    """(kind, value) of the spans of the rules."""
    out = []
    for start, kind, end in spans:
        value = _ASSIGN.match(text, start, end)[2] if kind == 0 else text[start:end]
        out.append((KINDS[kind], value))
    return out


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Places of all strings of the alphabet outside the rules' spans, without full stops at their ends."""
    out, at = [], 0
    for start, _, end in [*spans, (len(text), 0, len(text))]:
        for m in _CANDIDATE.finditer(text, at, max(at, start)):
            a, b = m.span()
            while b > a and text[b - 1] == ".":
                b -= 1
            if b - a >= 6:
                out.append((a, b))
        at = max(at, end)
    return out


class Formats:
    """Automata of the kinds and of plain strings."""

    def __init__(self, samples: dict[str, list[str]]):
        self.kinds = [Automaton([shape(v) for v in samples[k]]) for k in KINDS[:3] if samples.get(k)]
        forms = Counter(shape(v) for v in samples.get("plain", []))
        least = _RARE * forms.total()
        self.plain = Automaton([form for form, n in forms.items() for _ in range(n) if n > least])
        self._values: dict[str, float] = {}
        self._forms: dict[str, float] = {}

    def margin(self, value: str) -> float:
        """How much likelier the format is as a credential's; below 0 without any known credential."""
        known = self._values.get(value)
        if known is not None:
            return known
        form = shape(value)
        if form not in self._forms:
            if len(self._forms) >= _REMEMBERED:
                self._forms.clear()
            best = max((a.log_likelihood(form) for a in self.kinds), default=float("-inf"))
            # what no automaton knows is as likely a plain string's
            self._forms[form] = best - max(self.plain.log_likelihood(form), any_string(form))
        if len(value) <= _SHORT:
            if len(self._values) >= _REMEMBERED:
                self._values.clear()
            self._values[value] = self._forms[form]
        return self._forms[form]

    def spans(self, text: str, margin: float = MARGIN) -> list[Span]:
        """All spans of a text, by start, then kind."""
        base = base_spans(text)
        if not self.kinds:
            return base
        added = [(a, 3, b) for a, b in candidates(text, base) if self.margin(text[a:b]) >= margin]
        return sorted(base + added)


def learn_formats(
    docs: DataFrame, text_column: str = "text", sample: int = SAMPLE, plain_sample: int = PLAIN_SAMPLE
) -> Formats:
    """Automata from all rows of `docs`: of each kind the `sample` values, and `plain_sample` candidates, that
    come first by a hash, every value once however often it occurs.

    A batch of rows hands on no more than its own first ones, and the driver gets no more than three
    times `sample` and one `plain_sample`.
    """
    wanted = dict.fromkeys(KINDS[:3], sample) | {"plain": plain_sample}

    def order(value: str) -> bytes:
        return hashlib.md5(value.encode()).digest()

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, set[str]] = {kind: set() for kind in wanted}
            for text in batch["text"]:
                base = base_spans(text)
                for kind, value in labelled_values(text, base):
                    found[kind].add(value)
                found["plain"].update(text[a:b] for a, b in candidates(text, base))
            rows = [
                (kind, place, value)
                for kind, some in found.items()
                for place, value in heapq.nsmallest(wanted[kind], ((order(v), v) for v in some))
            ]
            yield pd.DataFrame(rows, columns=["kind", "place", "value"], dtype=object)

    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = texts.mapInPandas(values, "kind string, place binary, value string").distinct()
    by_place = Window.partitionBy("kind").orderBy("place", "value")
    ranked = found.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= max(wanted.values()))
    limit = F.when(F.col("kind") == "plain", plain_sample).otherwise(sample)
    samples: dict[str, list[str]] = {}
    for kind, value in ranked.where(F.col("rank") <= limit).select("kind", "value").collect():
        samples.setdefault(kind, []).append(value)
    return Formats(samples)


def _scanned(text: Column, formats: Formats, margin: float) -> Column:
    @F.pandas_udf("array<struct<start:int,kind:int,end:int>>")
    def scan(texts: pd.Series) -> pd.Series:
        rows = (formats.spans(t, margin) for t in texts)
        return pd.Series([[{"start": a, "kind": k, "end": b} for a, k, b in row] for row in rows], dtype=object)

    return scan(F.coalesce(text, F.lit("")))


def secret_spans(
    docs: DataFrame,
    formats: Formats | None = None,
    margin: float = MARGIN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, found (array of start, kind, end by start, then kind).

    start and end count code points, end exclusive; kind counts in `KINDS`. `formats` are learned from
    `docs` unless given. A null text counts as empty and has no spans; texts are scanned whole,
    repeated rows each; no rows give no rows.
    """
    formats = formats or learn_formats(docs, text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"), _scanned(F.col(text_column), formats, margin).alias("found")
    )


def span_digests(spans: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of a result of `secret_spans`."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    place = lambda s: F.concat_ws(":", name(s), s["start"], s["end"])
    written = lambda found: F.array_join(F.transform(found, place), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < 3)
    return spans.select(
        "doc_id",
        *(count(i).alias(f"n_{KINDS[i]}") for i in range(3)),
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with every run of overlapping spans replaced by the mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(
    docs: DataFrame,
    formats: Formats | None = None,
    margin: float = MARGIN,
    text_column: str = "text",
    length_column: str = "n_chars",
) -> DataFrame:
    """`docs` with every secret in its text replaced by a mask, and n_chars counted anew where there is one.

    A null text stays null. No row is dropped, other columns stay as they are.
    """
    formats = formats or learn_formats(docs, text_column)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else masked(t, formats.spans(t, margin)) for t in texts], dtype=object)

    (new,) = fresh(docs, "masked")
    clean = docs.withColumn(new, mask(F.col(text_column)))
    changed = ~F.col(new).eqNullSafe(F.col(text_column))

    def column(name: str) -> Column:
        if name == text_column:
            return F.col(new).alias(name)
        if name == length_column:
            return F.when(changed, F.length(new).cast("long")).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return clean.select(*map(column, docs.columns))
