"""Secrets by fixed patterns and by linking the parts of a credential.

The patterns give the base spans, which always stay. A credential has several
parts: an identifier, a secret and an endpoint. Alone, most of them look like
ordinary text, so they are weak candidates; what tells them is their company.
The parts of a text are found in one scan. Each weak candidate's interval, wider
by ``reach`` code points on both sides, is joined with the intervals of the
parts in its scope, a block of text between blank lines, and the candidate is
reported only if the parts met complement it.

All of it are column functions. The two sides of the join are parts of one text,
so it is done within the row and nothing is shuffled: parts are disjoint and in
order, hence all that an interval can meet lies in a slice of fixed length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import column

KINDS = ("assign", "access", "hex", "user", "key", "endpoint")
BASE_KINDS = KINDS[:3]
REACH = 200


def either_case(*words: str) -> str:
    """A pattern for any of the words, its ASCII letters in either case."""
    return "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in words) + ")"


_SET = r"""["']?\x20*[:=]\x20*["']?"""

# The patterns of the base spans. A value of an assignment has at least 8 characters.
ASSIGN = f"{either_case('password', 'passwd', 'secret', 'token', 'api_?key')}{_SET}([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

#: Groups 1 to 6: a value assigned, an access key, an endpoint, a user, a long hexadecimal number, a secret-looking word.
PARTS = "|".join([
    ASSIGN,
    f"({ACCESS})",
    r"""([A-Za-z][A-Za-z0-9+.-]{1,14}://[^\x00-\x20"'<>?&#]+|"""
    + either_case("host", "hostname", "server", "endpoint", "bucket") + _SET + "[A-Za-z0-9._:/-]{3,})",
    f"({either_case('user', 'username', 'user_name', 'login', 'account', 'client_id', 'access_key_id')}{_SET}[A-Za-z0-9@._+-]{{3,}})",
    f"({HEX})",
    "([A-Za-z0-9+/_-]{16,}={0,2})",
])
#: The shortest part is ``ab://c``.
LEAST_PART = 6
SCOPE_END = r"\n[\x20\t\r]*\n"
#: Texts without one of these have no identifier, so nothing is linked in them.
IDENTIFIER = f"{ACCESS}|{either_case('user', 'username', 'user_name', 'login', 'account', 'client_id', 'access_key_id')}{_SET}[A-Za-z0-9@._+-]"
#: Words that look like secrets hold three digits and three letters.
DIGITS, LETTERS = "[0-9].*[0-9].*[0-9]", "[A-Za-z].*[A-Za-z].*[A-Za-z]"

_CHUNK = 256
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def no_spans() -> Column:
    return F.array().cast("array<struct<start: int, rank: int, end: int, base: boolean>>")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(lengths: Column) -> Column:
    """For each number the sum of those before it; in chunks, as each step of a running sum copies what is there."""

    def running(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda sums, v: F.array_append(sums, F.element_at(sums, -1) + v))

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(_CHUNK))
    chunks = F.transform(starts, lambda i: running(F.slice(lengths, i, _CHUNK)))

    def joined(sums: Column) -> Column:
        before = running(F.transform(sums, lambda s: F.element_at(s, -1)))
        parts = F.zip_with(sums, F.slice(before, 1, F.size(sums)), lambda s, b: F.transform(F.slice(s, 1, F.size(s) - 1), lambda v: v + b))
        return F.flatten(parts)

    return let(chunks, joined)


def matches(text: Column, pattern: str, *groups: int) -> Column:
    """Where a pattern is found: structs of start, end and the text of each group (``g0``, ...)."""
    arrays = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, *groups)]

    def placed(found: Column) -> Column:
        def at(between: Column) -> Column:
            lengths = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.length(b) + F.length(m))

            def spans(before: Column) -> Column:
                first = F.zip_with(before, F.slice(between, 1, F.size(found)), lambda s, b: s + F.length(b))
                return F.zip_with(first, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end")))

            return let(sums_before(lengths), spans)

        return let(F.split(text, pattern, -1), at)

    spans = let(arrays[0], placed)
    for g, values in zip(groups, arrays[1:], strict=True):
        spans = _with_field(spans, f"g{g}", values)
    return spans


def _with_field(structs: Column, name: str, values: Column) -> Column:
    return F.zip_with(structs, values, lambda s, v: s.withField(name, v))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(True).alias("base")))


def base_spans(text: Column) -> Column:
    """Structs of start, rank of the kind, end and base, by kind, then start."""
    assigned = F.filter(matches(text, ASSIGN, 1), lambda m: F.length(m["g1"]) >= LEAST_VALUE)
    found = {"assign": assigned, "access": matches(text, ACCESS), "hex": matches(text, HEX)}
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    return F.concat(*[F.when(text.rlike(patterns[k]), _spans(k, found[k])).otherwise(no_spans()) for k in BASE_KINDS])


def _parts(scope: Column) -> Column:
    """The parts of a scope in order; ``role`` is the kind, or empty for what is no candidate."""

    def role(m: Column) -> Column:
        secret_like = m["g6"].rlike(DIGITS) & m["g6"].rlike(LETTERS)
        return (
            F.when(F.length(m["g1"]) >= LEAST_VALUE, "assign").when(m["g2"] != "", "access").when(m["g3"] != "", "endpoint")
            .when(m["g4"] != "", "user").when(m["g5"] != "", "hex").when(secret_like & ~m["g6"].rlike(f"{ACCESS}|{HEX}"), "key")
            .when(m["g6"].rlike(HEX), "held_hex").when(m["g6"].rlike(ACCESS), "held_access").otherwise("")
        )

    return F.transform(
        matches(scope, PARTS, 1, 2, 3, 4, 5, 6), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), role(m).alias("role"))
    )


def linked_parts(scope: Column, reach: int) -> Column:
    """The weak candidates of a scope whose widened interval meets parts that complement them."""
    most = reach // LEAST_PART + 2  # parts that lie within reach on one side

    def reported(parts: Column) -> Column:
        def links(weak: Column, i: Column) -> Column:
            near = F.slice(parts, F.greatest(i - most + 1, F.lit(1)), 2 * most + 1)

            def met(*roles: str) -> Column:
                return F.exists(near, lambda p: p["role"].isin(*roles) & (p["start"] - weak["end"] <= reach) & (weak["start"] - p["end"] <= reach))

            identifier, secret = met("access", "held_access"), met("assign", "hex", "held_hex")
            user, key, endpoint = met("user"), met("key"), met("endpoint")
            return (
                F.when(weak["role"] == "key", identifier | (user & endpoint))
                .when(weak["role"] == "user", secret | (key & endpoint))
                .when(weak["role"] == "endpoint", (identifier | user) & (secret | key))
                .otherwise(F.lit(False))
            )

        return F.filter(parts, links)

    return let(_parts(scope), reported)


def linked_spans(text: Column, reach: int) -> Column:
    """Structs like those of `base_spans` for the weak candidates that are linked, all scopes of the text."""
    rank = F.create_map(*[x for kind in KINDS for x in (F.lit(kind), F.lit(KINDS.index(kind)))])

    def within(scopes: Column, ends: Column, before: Column) -> Column:
        def spans(scope: Column, i: Column) -> Column:
            begin = F.get(before, i)
            return F.when(
                scope.rlike(IDENTIFIER),
                F.transform(linked_parts(scope, reach), lambda p: F.struct(
                    (p["start"] + begin).alias("start"), F.element_at(rank, p["role"]).alias("rank"),
                    (p["end"] + begin).alias("end"), F.lit(False).alias("base"))),
            )

        return F.flatten(F.filter(F.transform(scopes, spans), lambda s: s.isNotNull()))

    ends = F.concat(F.transform(F.regexp_extract_all(text, F.lit(SCOPE_END), F.lit(0)), F.length), F.array(F.lit(0)))
    return let(
        F.split(text, SCOPE_END, -1),
        lambda scopes: let(ends, lambda e: let(
            sums_before(F.zip_with(scopes, e, lambda s, n: F.length(s) + n)), lambda before: within(scopes, e, before))),
    )


def find_secrets(docs: DataFrame, reach: int = REACH, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: all spans (kind, start, end, base), by start, then kind.

    Base spans are assignments, access keys and long hexadecimal numbers. Added ones
    are of the kinds user (an identifier), key (a word that looks like a secret) and
    endpoint. A key is reported near an access key, or near both a user and an
    endpoint; a user near an assignment or a long hexadecimal number, or near both a
    key and an endpoint; an endpoint near both some identifier and some secret. Near
    is within ``reach`` code points in the same scope.

    Positions are code points of the whole text, ends exclusive. NULL and empty
    texts have none. Repeated rows stay; a column called ``secrets``, in any case,
    is replaced; an empty table gives an empty result.
    """
    value = column(text)
    added = F.when(value.rlike(IDENTIFIER), linked_spans(value, reach)).otherwise(no_spans())
    found = F.array_sort(F.concat(F.coalesce(base_spans(value), no_spans()), F.coalesce(added, no_spans())))
    kinds = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        found, lambda s: F.struct(F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))
    )
    kept = [column(c) for c in docs.columns if c.lower() != "secrets"]
    return docs.select(*kept, F.coalesce(spans, F.array()).cast(SPANS).alias("secrets"))
