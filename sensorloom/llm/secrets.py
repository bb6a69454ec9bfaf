"""Secret scans that link the parts of a credential.

Strong forms (assignments, access ids, long hexadecimal runs) are reported wherever they stand.
Weak parts (a user or client name, an opaque token, a service address) mean nothing alone; they
are reported only where a complementary part lies near in the same scope. The link is an interval
join of the parts' spans: a sweep over the parts of a scope in order, which compares each with the
furthest end before it and the nearest start after it, and so makes no pairs.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from sensorloom.llm.common import per_text
from sensorloom.session import written

# The strong forms, in the order in which spans that start together are listed.
STRONG = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
# Weak parts.
IDENTITY = re.compile(
    r"""\b(?:client_?id|access_?key_?id|user_?name|user|login|account|tenant)\b["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I
)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{4,}|\b(?:host|endpoint|server|region)\b[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{4,}", re.I)
WEAK = ("identity", "opaque", "endpoint")
#: Which parts each kind completes: a name needs a secret, a secret a name, an address a secret.
ROLE = {"access": "name", "identity": "name", "assign": "secret", "hex": "secret", "opaque": "secret", "endpoint": "place"}
SCOPE_BREAK = re.compile(r"\n[\x20\t\r]*\n")
#: Code points between the spans of two parts of one credential, at most.
REACH = 200
LEAST_BITS = 3.5

PART = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("scope", IntegerType())])


def _bits(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def _opaque(token: str) -> bool:
    """Letters of both cases and digits, spread like random characters."""
    kinds = any(c.isdigit() for c in token), any(c.islower() for c in token), any(c.isupper() for c in token)
    return all(kinds) and _bits(token) >= LEAST_BITS


def find_parts(text: str) -> list[tuple[str, int, int, int]]:
    """All parts in a text as (kind, start, end, scope), in order; scopes are parted by blank lines."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    strong = sorted((start, end) for _, start, end in found)
    weak = [("identity", *m.span()) for m in IDENTITY.finditer(text)]
    weak += [("opaque", *m.span()) for m in OPAQUE.finditer(text) if _opaque(m[0])]
    weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if strong and weak:  # a weak part inside a strong one is the same thing
        starts = [start for start, _ in strong]
        ends, most = [], -1
        for _, end in strong:
            ends.append(most := max(most, end))
        weak = [p for p in weak if not (k := bisect.bisect_right(starts, p[1])) or ends[k - 1] < p[2]]
    found += weak
    if not found:
        return []
    found.sort(key=lambda p: (p[1], (STRONG + WEAK).index(p[0])))
    breaks, scope, out = [m.start() for m in SCOPE_BREAK.finditer(text)], 0, []
    for kind, start, end in found:
        while scope < len(breaks) and breaks[scope] < start:
            scope += 1
        out.append((kind, start, end, scope))
    return out


def scan_parts(docs: DataFrame) -> DataFrame:
    """Per document its ``parts``, with ``doc_id`` and a hash of the text to know the row by."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), "text")
    return per_text(keyed, ["doc_id", "_hash"], "text", [StructField("parts", ArrayType(PART))], lambda text: (find_parts(text),))


def _is(role: str) -> Column:
    return F.col("kind").isin([k for k, r in ROLE.items() if r == role])


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts (``doc_id``, ``_hash``, ``kind``, ``start``, ``end``, ``scope``) with a complement within ``reach``."""
    scope = ["doc_id", "_hash", "scope"]
    until = Window.partitionBy(*scope).orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*scope).orderBy("start", "end", "kind").rowsBetween(1, Window.unboundedFollowing)

    def near(role: str) -> Column:
        last, first = F.max(F.when(_is(role), F.col("end"))).over(until), F.min(F.when(_is(role), F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= reach, F.lit(False)) | F.coalesce(first - F.col("end") <= reach, F.lit(False))

    seen = parts.withColumns({f"_{role}": near(role) for role in ("name", "secret", "place")})
    secret = (F.col("kind") == "opaque") & (F.col("_name") | F.col("_place"))
    other = F.col("kind").isin("identity", "endpoint") & F.col("_secret")
    return seen.filter(secret | other).select(*scope, "kind", "start", "end")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end; code points, end exclusive) of every document.

    Spans hold every strong form, and each weak part that a complementary part completes within
    ``reach`` code points of the same scope. A null or empty text has no spans. Rows that agree in
    ``doc_id`` and text get equal spans; a null ``doc_id`` is kept. An empty table gives no rows.
    Other columns are ignored.
    """
    scanned = written(scan_parts(docs), "parts")
    has_weak = F.exists("parts", lambda p: p["kind"].isin(*WEAK))
    holders = scanned.filter(has_weak).dropDuplicates(["doc_id", "_hash"])
    exploded = holders.select("doc_id", "_hash", F.inline("parts"))
    linked = link_parts(exploded, reach).groupBy("doc_id", "_hash").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_weak"))
    linked = linked.withColumnsRenamed({"doc_id": "_id", "_hash": "_h"})
    bare = F.transform(F.filter("parts", lambda p: p["kind"].isin(*STRONG)), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))
    # Only documents with weak parts can have links; all others stay out of the join.
    lone = scanned.filter(~has_weak).select("doc_id", bare.alias("spans"))
    some = scanned.filter(has_weak).join(linked, same, "left")
    some = some.select("doc_id", F.concat(bare, F.coalesce("_weak", F.array().cast("array<struct<kind:string,start:int,end:int>>"))).alias("spans"))
    return lone.unionAll(some)


def digest(found: DataFrame) -> DataFrame:
    """The counts and joined spans of ``find_secrets``."""
    order = F.create_map(*[x for i, kind in enumerate(STRONG + WEAK) for x in (F.lit(kind), F.lit(i))])
    ranked = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    strong = F.filter("_spans", lambda s: s["rank"] < len(STRONG))
    return found.select("doc_id", ranked.alias("_spans")).select(
        "doc_id", *[count(k) for k in STRONG], F.sha2(joined(strong), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans")
    )
