"""Secret scans with multipart credential linking.

Strong findings need no company: assignments of a long value to a secret's
name, access identifiers and long hexadecimal runs. Weak candidates (an
account identifier, a mixed string of 32 or more characters, an endpoint) are
reported only where complementary parts meet: a secret and an identifier or an
endpoint whose gap is at most ``reach`` code points. The meeting is an interval
join on (row, cell): a secret is found in the cells it covers, its possible
partners in the cells around theirs, so that no task pairs all parts of a text.
A secret's run is taken whole, however long; '=' or ':' may stand before it, and
an account's name may have a prefix that ends in '_' or '.'. A run that a strong
finding holds is reported once, as that. A run inside an endpoint is part of its
path and no secret, but for credentials before '@' and values of its query;
and no span is the complement of one that it lies in.

Spans are code points, end exclusive. Null text is empty, texts are scanned
whole, equal rows have equal results (rows meet by a hash of id and text), and
an empty table gives an empty result. Input columns named like an output column
are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

KINDS = ["assign", "access", "hex", "account", "secret", "endpoint"]

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run is found whole, as by [0-9a-f]+
ACCOUNT = re.compile(r"""(?ai)(?<![A-Za-z0-9])(?:client_?id|access_?key_?id|account(?:_?name)?|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?a)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+")


def _mixed(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and len(set(s)) >= 10


#: Inside an endpoint: what stands before '@', and the values of its query.
_HELD = re.compile(r"(?<=://)[^/?#@]*(?=@)|(?<=[?&;])[^=&;#]*=([^&;#]*)")


def _within(span, spans) -> bool:
    return any(a <= span[0] and span[1] <= b for a, b in spans)


def _secrets(text: str, strong: list[tuple[int, int]], endpoints: list[tuple[int, int]]) -> list[tuple[int, int]]:
    held = [(a + m.start(m.lastindex or 0), a + m.end(m.lastindex or 0))
            for a, b in endpoints for m in _HELD.finditer(text[a:b])]
    out = [(a + x, a + y) for (a, b) in held for x, y in (m.span() for m in SECRET.finditer(text[a:b]))]
    out += [m.span() for m in SECRET.finditer(text)
            if not any(m.start() < b and a < m.end() for a, b in endpoints)]
    return sorted({x for x in out if _mixed(text[x[0]:x[1]]) and not _within(x, strong)})


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of strong findings and weak candidates."""
    out = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(2, *m.span()) for m in HEX.finditer(text)]
    out += [(3, *m.span()) for m in ACCOUNT.finditer(text)]
    strong = [x[1:] for x in out if x[0] < 3]
    ends = [m.span() for m in ENDPOINT.finditer(text)]
    out += [(4, *x) for x in _secrets(text, strong, ends)]
    return out + [(5, *x) for x in ends]


def _is_kind(kind: int):
    return lambda p: p["kind"] == kind


def _listed(spans):
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked_parts(found: DataFrame, reach: int) -> DataFrame:
    """(k1, k2, linked): the weak parts of each row that meet a complementary one."""
    parts = found.select("k1", "k2", F.explode("found").alias("p")).select("k1", "k2", "p.*").distinct()
    weak = parts.filter("kind IN (1, 3, 4, 5)").withColumn("cell", F.floor(F.col("start") / reach))
    secret = (weak.filter("kind = 4")
              .withColumn("cell", F.explode(F.sequence("cell", F.floor(F.col("end") / reach))))
              .select("k1", "k2", "cell", F.struct("kind", "start", "end").alias("s")))
    # a span reaches from its first cell less one to its last cell and one more
    other = (weak.filter("kind <> 4")
             .withColumn("cell", F.explode(F.sequence(
                 F.floor(F.col("start") / reach) - 2, F.floor(F.col("end") / reach) + 2)))
             .select("k1", "k2", "cell", F.struct("kind", "start", "end").alias("o")))
    # both may cover several cells: a pair can meet more than once and is listed once
    met = secret.join(other, ["k1", "k2", "cell"]).filter(
        (F.greatest("s.start", "o.start") - F.least("s.end", "o.end") <= reach)
        & ~((F.col("o.start") <= F.col("s.start")) & (F.col("s.end") <= F.col("o.end")))
        & ~((F.col("s.start") <= F.col("o.start")) & (F.col("o.end") <= F.col("s.end"))))
    # access identifiers are strong and already reported
    return (met.select("k1", "k2", F.explode(F.array("s", "o")).alias("p")).filter("p.kind >= 3")
            .groupBy("k1", "k2").agg(F.collect_set("p").alias("linked")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 400) -> DataFrame:
    """``df`` with n_assign, n_access, n_hex, base (strong spans listed) and
    spans (strong and linked ones)."""
    common.python_ready(df)
    kind = "array<struct<kind:int,start:int,end:int>>"

    @F.pandas_udf(kind)
    def finder(texts):
        return texts.map(lambda t: [dict(zip(("kind", "start", "end"), x, strict=True)) for x in find(t)])

    text = common.text_of(f"`{text_col}`")
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), text)
    rest = [c for c in df.columns if c != text_col and c != id_col]
    found = common.stored(df.select(
        F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in rest], k1.alias("__k1"), k2.alias("__k2"),
        finder(text).alias("__found")), "secrets")
    linked = linked_parts(found.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"),
                                       F.col("__found").alias("found")).filter(F.size("found") > 0), reach)
    joined = found.join(linked.withColumnsRenamed({"k1": "__k1", "k2": "__k2", "linked": "__linked"}),
                        ["__k1", "__k2"], "left")
    base = F.filter("__found", lambda p: p["kind"] < 3)
    extra = F.coalesce("__linked", F.array().cast(kind))
    counts = {f"n_{n}": F.size(F.filter("__found", _is_kind(k))).cast("long")
              for k, n in enumerate(KINDS[:3])}
    return common.with_replaced(joined, counts | {"base": _listed(base), "spans": _listed(F.concat(base, extra))},
                                drop=("__k1", "__k2", "__found", "__linked"))
