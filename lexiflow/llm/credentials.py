"""Secret scan with multipart credential linking (operator 2).

Strong parts are reported wherever they stand: assignments of a secret, access
identifiers, long hexadecimal runs.  Weak parts -- opaque 40-character strings,
user names, endpoints -- are reported only where complementary parts lie in the
same scope (``scope`` code points between the two spans):

* an opaque string needs an identifier (access or user name);
* a user name needs a secret (assignment, hexadecimal run or opaque string);
* an endpoint needs both an identifier and a secret.

The parts of a text are intervals.  They are linked by an interval join: every
interval is laid on the scope-wide bins it can reach, parts meet on (text, bin)
and the distance is tested; a semi-join gives each part once however many
partners it has, so no pairs are emitted.  Only texts with a weak part enter the
join, once per distinct text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import cut, free_name, give_back, text_or_empty

#: The kinds in the order of the span listing, and their patterns.
KINDS = ["assign", "access", "hex", "opaque", "user", "endpoint"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
USER = re.compile(r"""(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""", re.I | re.A)
ENDPOINT = re.compile(r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|\d{1,3}(?:\.\d{1,3}){3}:\d{2,5})""", re.A)
#: A text without a match of this has no weak part (Java syntax).
WEAK_HINT = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])|(?i:user|login|client_?id|account)|://|\.\d{1,3}:\d"
#: Code points between two spans of one scope, at most.
SCOPE = 200

_SPANS = "array<struct<kind: int, start: int, end: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def strong_parts(text: str) -> list[tuple[int, int, int]]:
    """Base spans: leftmost non-overlapping per kind; too short ones are dropped after matching."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    return found


def weak_parts(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that need a partner; an opaque string mixes three classes and lies outside strong spans."""
    found = []
    for m in OPAQUE.finditer(text):
        s = m[0]
        mixed = any(c.islower() for c in s) and any(c.isupper() for c in s) and any(c.isdigit() for c in s)
        if mixed and not any(a < m.end() and m.start() < b for _, a, b in strong):
            found.append((3, *m.span()))
    found += [(4, *m.span()) for m in USER.finditer(text)]
    found += [(5, *m.span()) for m in ENDPOINT.finditer(text)]
    return found


def _scan(text: Column, weak: bool) -> Column:
    @F.arrow_udf(_SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            t = value.as_py()
            spans = strong_parts(t)
            if weak:
                spans += weak_parts(t, spans)
            out.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(spans, key=lambda x: (x[1], x[0], x[2]))])
        done = pa.array(out, type=_SPAN_TYPE)
        del out
        give_back()
        return done

    return scan(text_or_empty(text))


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Interval semi-join: rows (key, kind, start, end) of ``left`` with a span of ``right`` in scope."""
    reach = F.explode(F.sequence(F.expr(f"(greatest(start - {scope}, 0)) div {scope}"), F.expr(f"(end + {scope}) div {scope}")))
    probes = left.withColumn("bin", reach).alias("l")
    index = right.withColumn("bin", F.explode(F.sequence(F.expr(f"start div {scope}"), F.expr(f"end div {scope}")))).alias("r")
    gap = (F.col("l.start") - F.col("r.end") <= scope) & (F.col("r.start") - F.col("l.end") <= scope)
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.bin") == F.col("r.bin"))
    return probes.join(index, same & gap, "left_semi").drop("bin").distinct()


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak spans that have their complement: (key, kind, start, end).

    ``parts`` has a row (key, kind, start, end) per span, distinct.
    """
    identifiers = parts.where("kind in (1, 4)")
    secrets = parts.where("kind in (0, 2, 3)")
    opaque = _near(parts.where("kind = 3"), identifiers, scope)
    users = _near(parts.where("kind = 4"), secrets, scope)
    endpoints = _near(_near(parts.where("kind = 5"), identifiers, scope), secrets, scope)
    return opaque.unionByName(users).unionByName(endpoints)


def find_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE, spans_col: str = "spans") -> DataFrame:
    """``df`` with an array of spans (kind: index in ``KINDS``; start, end in code points, end
    exclusive), ordered by start, kind and end.

    Null and empty texts have no spans.  Repeated rows are kept, each with its
    spans.  All columns stay; ``spans_col`` replaces a column of that name.
    """
    text = text_or_empty(text_col)
    key, found, linked = (free_name(df, n) for n in ("_key", "_found", "_linked"))
    hint = text.rlike(WEAK_HINT)
    plain = df.where(~hint).withColumn(spans_col, _scan(F.col(text_col), weak=False))
    rich = cut(df.where(hint).withColumn(found, _scan(F.col(text_col), weak=True)).withColumn(key, F.sha2(text, 256)))
    weak = F.exists(found, lambda s: s["kind"] > 2)
    parts = rich.where(weak).select(F.col(key).alias("key"), F.inline(found)).distinct()
    kept = (
        link_parts(cut(parts), scope)
        .groupBy(F.col("key").alias(key))
        .agg(F.collect_list(F.struct(F.col("kind").alias("kind"), "start", "end")).alias(linked))
    )
    strong = F.filter(found, lambda s: s["kind"] <= 2)
    both = F.array_sort(
        F.concat(strong, F.coalesce(F.col(linked), F.array().cast(_SPANS))),
        lambda a, b: F.when((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1)
        .when((a["start"] == b["start"]) & (a["kind"] == b["kind"]), a["end"] - b["end"])
        .otherwise(1),
    )
    joined = rich.where(weak).join(kept, key, "left").withColumn(spans_col, both)
    alone = rich.where(~weak).withColumn(spans_col, F.col(found))
    keep = [F.col(c) for c in df.columns if c.lower() != spans_col.lower()] + [F.col(spans_col)]
    return plain.select(*keep).unionByName(alone.select(*keep)).unionByName(joined.select(*keep))


def listing(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``[kind]``; of overlapping spans the first names the hole."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for value, holes in zip(texts, found):
            t, holes = value.as_py(), holes.as_py()
            if t is None or not holes:
                out.append(t)
                continue
            pieces, at = [], 0
            for s in holes:
                if s["start"] >= at:
                    pieces += [t[at : s["start"]], f"[{KINDS[s['kind']]}]"]
                at = max(at, s["end"])
            out.append("".join([*pieces, t[at:]]))
        return pa.array(out, type=pa.string())

    return run(text, spans)


def digest(df: DataFrame, spans_col: str = "spans") -> DataFrame:
    """The query's columns: counts of the base kinds, the digest of the base spans, the span listing."""
    spans = F.col(spans_col)
    base = F.filter(spans, lambda s: s["kind"] <= 2)

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return df.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listing(base), 256).alias("base_sha256"),
        listing(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["kind"] > 2)).cast("long").alias("n_linked"),
    )
