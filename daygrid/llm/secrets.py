"""Secret scans (native).

Three fixed kinds (``assign``, ``access``, ``hex``) are regular expressions.
The method's own kind, ``entropy``, takes candidate strings of key characters,
slides a window over each and keeps the Shannon entropy of the window's
characters up to date from incremental counts (one character enters, one
leaves). Thresholds depend on the character class of the candidate. Candidates
on the allow list (words, versions, dates, paths, UUIDs, documented sample
keys) are suppressed. What fixed spans cover is cut out of a candidate first; every
stretch left over is judged as a candidate of its own.

Spans are code-point offsets, end exclusive. Defined results: a null or empty
text has no spans; equal rows get equal results; U+FDD0 and U+FDD1 (Unicode
noncharacters, used as markers) count as one ordinary character in a text;
extra columns pass through, those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, let, ranges, table

# The patterns of the base kinds. Group 1 is what precedes the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"()(AKIA[A-Z0-9]{12,})"
HEX = r"()([0-9a-f]{32,})"
ASSIGN_VALUE = 8
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates of the entropy scan and its window.
CANDIDATE = r"()([A-Za-z0-9+/_=-]{20,})"
WINDOW = 20
#: Character class -> entropy in bits a window must reach. A random window of
#: 20 has about 3.5 (hexadecimal), 4.0 (one case and digits), 4.1 (base64).
CLASS_BITS = (("^[0-9a-fA-F]+$", 3.0), ("^([0-9a-z]+|[0-9A-Z]+)$", 3.5), (".", 3.7))
# The allow list; a candidate that matches any is no secret.
ALLOWED = (
    r"^[^0-9]*$",  # words and word chains without a digit
    r"^[0-9_=+/-]+$",  # numbers, dates, rules
    r"^[A-Za-z]+([_/-][A-Za-z]+)*[_/-]?[0-9]{1,4}$",  # names with a number
    r"^([A-Za-z]*[_/-])*v?[0-9]+([_-][0-9]+)*$",  # versions
    r"^([A-Za-z0-9]{1,12}[_/-])+[A-Za-z0-9]{1,12}$",  # paths and slugs of short parts
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"EXAMPLE",  # documented sample keys
)

#: Pieces whose lengths are summed together.
BLOCK = 256
MARK, CUT = "﷐", "﷑"


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _block_starts(n: Column) -> Column:
    """Sums of all numbers before each block of ``BLOCK``, so that no offset is summed from
    the beginning of the text."""
    blocks = ranges(F.ceil(F.size(n) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda k: _sum(F.slice(n, k * BLOCK + 1, F.lit(BLOCK))))
    return let(sums, lambda s: F.transform(blocks, lambda k: _sum(F.slice(s, F.lit(1), k))))


def _matches(text: Column, pattern: str, kind: str, min_value: int = 1) -> Column:
    """Spans of a pattern's leftmost matches: array<struct(start, end, kind, value)>.

    Every match is wrapped in markers, the text is split at them, and the odd
    pieces are the matches; their offsets are running sums of piece lengths.
    """
    marked = F.regexp_replace(F.translate(text, MARK + CUT, "??"), pattern, f"{MARK}$1{CUT}$2{MARK}")

    def spans(pieces: Column) -> Column:
        lens = F.transform(pieces, lambda p, i: F.char_length(p) - i % 2)
        return let(
            lens,
            lambda n: let(
                _block_starts(n),
                lambda starts: F.filter(
                    F.transform(
                        F.filter(ranges(F.size(pieces)), lambda i: i % 2 == 1),
                        lambda i: let(
                            F.get(starts, F.floor(i / BLOCK).cast("int")) + _sum(F.slice(n, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
                            lambda at: F.struct(
                                at.alias("start"), (at + F.get(n, i)).alias("end"), F.lit(KINDS.index(kind)).alias("kind"), F.substring_index(F.get(pieces, i), CUT, -1).alias("value")
                            ),
                        ),
                    ),
                    lambda s: F.char_length(s["value"]) >= min_value,
                ),
            ),
        )

    return F.when(text.rlike(pattern), let(F.split(marked, MARK), spans)).otherwise(F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>"))


def _passing_windows(value: Column, bits: Column, window: int) -> Column:
    """(first, last): offsets just behind the first and the last window of ``value`` whose
    entropy reaches ``bits`` (0 if none does).

    The state holds the count of every character of the window and
    s = sum(c * log2 c); entropy = log2(window) - s / window.
    """
    weight = lambda c: F.when(c > 0, c * F.log2(F.greatest(c, F.lit(1)))).otherwise(F.lit(0.0))
    change = lambda c, by: weight(c + by) - weight(c)

    def put(counts: Column, k: Column, n: Column) -> Column:
        return F.concat(F.slice(counts, F.lit(1), k), F.array(n), F.slice(counts, k + 2, F.size(counts) - k - 1))

    def scan(chars: Column) -> Column:
        def over(alphabet: Column) -> Column:
            return let(F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int") - 1), lambda ids: walk(alphabet, ids))

        def walk(alphabet: Column, ids: Column) -> Column:
            zero = F.struct(F.transform(alphabet, lambda _: F.lit(0)).alias("counts"), F.lit(0.0).alias("s"), F.lit(0).alias("first"), F.lit(0).alias("last"))

            def slide(state: Column, i: Column) -> Column:
                come = F.get(ids, i)
                gone = F.when(i >= window, F.get(ids, F.greatest(i - window, F.lit(0)))).otherwise(F.lit(-1))
                return let(F.struct(come.alias("come"), gone.alias("gone")), lambda x: step(state, i, x["come"], x["gone"]))

            def step(state: Column, i: Column, come: Column, gone: Column) -> Column:
                counts = state["counts"]
                s = F.when(come == gone, state["s"]).otherwise(
                    state["s"] + change(F.get(counts, come), 1) + F.when(gone >= 0, change(F.get(counts, F.greatest(gone, F.lit(0))), -1)).otherwise(0.0)
                )
                up = put(counts, come, F.get(counts, come) + 1)
                moved = F.when(come == gone, counts).when(gone < 0, up).otherwise(put(up, gone, F.get(counts, F.greatest(gone, F.lit(0))) - 1))

                def after(now: Column) -> Column:
                    passes = (i >= window - 1) & (F.log2(F.lit(float(window))) - now / window >= bits - 1e-9)
                    return F.struct(
                        moved.alias("counts"),
                        now.alias("s"),
                        F.when(passes & (state["first"] == 0), i + 1).otherwise(state["first"]).alias("first"),
                        F.when(passes, i + 1).otherwise(state["last"]).alias("last"),
                    )

                return let(s, after)

            return F.aggregate(ranges(F.size(ids)), zero, slide, lambda r: F.struct(r["first"], r["last"]))

        return let(F.array_distinct(chars), over)

    return let(F.split(value, ""), lambda c: let(F.filter(c, lambda x: x != ""), scan))


def _flagged(flags: Column, spans: Column) -> Column:
    """Flags of a text's characters with ``spans`` (by start, not overlapping) put in: 1 at
    the first character of a run of spans that overlap, 2 at the others, 0 outside."""
    ends = F.transform(spans, lambda s: s["end"])

    def put(end: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(end, i - 1), F.lit(0))
            first = F.greatest(F.get(flags, s["start"]), F.lit(1))
            return F.concat(F.slice(flags, before + 1, s["start"] - before), F.array(first), F.array_repeat(F.lit(2), s["end"] - s["start"] - 1))

        last = F.get(end, F.size(end) - 1)
        tail = F.slice(flags, last + 1, F.size(flags) - last)
        return F.flatten(F.concat(F.transform(spans, part), F.array(tail)))

    return F.when(F.size(spans) == 0, flags).otherwise(let(ends, put))


def _covered(text: Column, kinds: list[Column]) -> Column:
    """Flags of the characters of ``text`` that spans of any kind cover."""

    def with_kinds(flags: Column, left: list[Column]) -> Column:
        return let(_flagged(flags, left[0]), lambda f: with_kinds(f, left[1:])) if left else flags

    return with_kinds(F.array_repeat(F.lit(0), F.char_length(text)), kinds)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _uncovered(text: Column, kinds: list[Column]) -> Column:
    """``text`` with blanks for what spans cover, so that what they leave over of a
    candidate is found as candidates of their own."""
    blank = lambda f: F.array_join(F.transform(_characters(text), lambda c, i: F.when(F.get(f, i) > 0, " ").otherwise(c)), "")
    return let(_covered(text, kinds), blank)


def _entropy_spans(candidates: Column, cut: Column, window: int) -> Column:
    """Per candidate from its first passing window to its last, if any passes. ``cut``:
    whether spans were cut out; what is left of a candidate is then held against the
    allow list without the characters that joined it."""
    bits = lambda v: F.coalesce(*[F.when(v.rlike(p), F.lit(b)) for p, b in CLASS_BITS])
    allowed = lambda v: v.rlike("|".join(f"(?:{p})" for p in ALLOWED))
    judged = F.filter(candidates, lambda s: ~allowed(F.when(cut, F.btrim(s["value"], F.lit("+/_=-"))).otherwise(s["value"])))
    found = F.transform(judged, lambda s: F.struct(s.alias("s"), let(bits(s["value"]), lambda b: _passing_windows(s["value"], b, window)).alias("ends")))
    return F.transform(
        F.filter(found, lambda x: x["ends"]["first"] > 0),
        lambda x: F.struct(
            (x["s"]["start"] + x["ends"]["first"] - window).alias("start"),
            (x["s"]["start"] + x["ends"]["last"]).alias("end"),
            x["s"]["kind"].alias("kind"),
            x["s"]["value"].alias("value"),
        ),
    )


_OWN = ("_assign", "_access", "_hex", "_candidates", "_entropy", "_cut", "secret_spans")


def scan_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``secret_spans``: array<struct(start, end, kind)> by start, then kind.

    ``kind`` indexes ``KINDS``.
    """
    docs, back = aside(docs.drop("secret_spans"), _OWN)
    return back(_scanned(docs, window).drop(*_OWN[:-1]))


def _scanned(docs: DataFrame, window: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")
    step = docs.withColumns(
        {
            "_assign": F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), _matches(text, ASSIGN, "assign", ASSIGN_VALUE)).otherwise(none),
            "_access": F.when(F.contains(text, F.lit("AKIA")), _matches(text, ACCESS, "access")).otherwise(none),
            "_hex": _matches(text, HEX, "hex"),
        }
    )
    base = [F.col(c) for c in ("_assign", "_access", "_hex")]
    step = step.withColumn("_cut", F.size("_assign") + F.size("_access") + F.size("_hex") > 0)
    step = step.withColumn("_candidates", _matches(F.when(F.col("_cut") & text.rlike(CANDIDATE), _uncovered(text, base)).otherwise(text), CANDIDATE, "entropy"))
    step = step.withColumn("_entropy", _entropy_spans(F.col("_candidates"), F.col("_cut"), window))
    spans = F.transform(F.sort_array(F.transform(F.concat(*base, "_entropy"), lambda s: F.struct(s["start"], s["kind"], s["end"]))), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    return step.withColumn("secret_spans", spans)


def _is_kind(kind: int):
    return lambda s: s["kind"] == kind


def redact(docs: DataFrame, window: int = WINDOW, by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``by`` and ``n_chars``
    (if there is such a column) set to the new length; clean texts stay as they are."""
    moved, back = aside(docs, _OWN)
    kinds = [F.filter("secret_spans", _is_kind(k)) for k in range(len(KINDS))]
    cut = lambda f: F.array_join(F.transform(_characters(F.col("text")), lambda c, i: F.when(F.get(f, i) == 0, c).when(F.get(f, i) == 1, by).otherwise("")), "")
    found = F.size("secret_spans") > 0
    out = _scanned(moved, window).withColumn("text", F.when(found, let(_covered(F.col("text"), kinds), cut)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(found, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(out.drop(*_OWN)).select(*docs.columns)


def _joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5(spark, sf_dir: str) -> DataFrame:
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return out.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.filter("secret_spans", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )
