"""Secret scan: fixed patterns, and stretches of high entropy inside long strings.

Base kinds are found by patterns. The method adds ``entropy_hex`` and ``entropy_base64``:
every string of ``WINDOW`` or more characters of the class is a candidate, a window slides
over it, and the counts of the class's characters are updated by the one that enters and the
one that leaves, and with them the window's Shannon entropy. Windows that reach the
threshold of their class merge into spans. Candidates that match ``ALLOWED`` (words of
letters only, plain numbers, placeholders) are suppressed; base spans never are.

Only SQL functions are used, row by row: nothing is shuffled. Spans are code points, end
exclusive. A null text is an empty one and has no spans; repeated rows give equal rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind: pattern, group that holds the value, least length of the value.
BASE_KINDS = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    # A run of these letters is matched whole, so its least length can stand in the pattern.
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
WINDOW = 20
#: kind: character class, its alphabet as counted, least bits of a window.
ENTROPY_KINDS = {
    "entropy_hex": ("[0-9A-Fa-f]", "0123456789abcdef", 3.0),
    "entropy_base64": (
        "[A-Za-z0-9+/_-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.8,
    ),
}
ALLOWED = (
    r"^[A-Za-z_-]+$",
    r"^[0-9_-]+$",
    r"(?i)example|sample|placeholder|changeme|dummy|xxxxxx",
    r"(?i)0123456789abcdef|abcdefghijklmnop",
)
KINDS = (*BASE_KINDS, *ENTROPY_KINDS)
SPAN = "struct<start:int,end:int,kind:int>"
# Entropy sums are whole numbers of this part of a bit, so no rounding adds up on long strings.
UNIT = 1 << 20
#: Matches whose places are added up one by one.
STEPS = 256


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often and in whatever function
    ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _places(text: Column, pattern: str) -> Column:
    """Start, end and text of every match, left to right.

    SQL has no function for places. The text split at the matches gives the gaps, and gaps
    and matches in turn add up to the places: within blocks of ``STEPS`` matches first, as to
    append to an array is to copy it, then from block to block.
    """
    steps = _bound(
        F.split(text, pattern, -1),
        lambda gaps: F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), m.alias("value")),
        ),
    )
    kind = "array<struct<start:int,end:int,value:string>>"

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + p["gap"]
        span = F.struct(start.alias("start"), (start + p["size"]).alias("end"), p["value"].alias("value"))
        return F.struct((start + p["size"]).alias("at"), F.array_append(state["spans"], span).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def in_block(steps: Column, block: Column) -> Column:
        return F.aggregate(F.slice(steps, block * STEPS + 1, F.lit(STEPS)), empty, step)

    def shifts(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(
            blocks, none,
            lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.array_append(s["before"], s["at"]).alias("before")),
            lambda s: s["before"],
        )

    def moved(block: Column, shift: Column) -> Column:
        return F.transform(
            block["spans"],
            lambda p: F.struct((p["start"] + shift).alias("start"), (p["end"] + shift).alias("end"), p["value"].alias("value")),
        )

    def placed(blocks: Column) -> Column:
        return _bound(shifts(blocks), lambda before: F.flatten(F.transform(blocks, lambda b, i: moved(b, F.get(before, i)))))

    blocks = _bound(steps, lambda all_steps: F.transform(
        F.sequence(F.lit(0), F.call_function("div", F.greatest(F.size(all_steps) - 1, F.lit(0)), F.lit(STEPS)).cast("int")),
        lambda block: in_block(all_steps, block),
    ))
    return _bound(blocks, placed)


def _base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE_KINDS[kind]
    places = _places(text, pattern)
    if group:
        places = _bound(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
            lambda values: F.filter(places, lambda p, i: F.length(F.get(values, i)) >= least),
        )
    number = F.lit(KINDS.index(kind))
    spans = F.transform(places, lambda p: F.struct(p["start"], p["end"], number.alias("kind")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _entropy_of(value: Column, shift: Column, kind: str) -> Column:
    """Spans of the windows of one candidate that reach the threshold; ``shift`` is added."""
    _, alphabet, least = ENTROPY_KINDS[kind]
    folded = F.lower(value) if alphabet == alphabet.lower() else value
    moves = _bound(
        F.transform(F.split(folded, ""), lambda c: F.position(c, F.lit(alphabet)) - 1),
        lambda letters: F.transform(
            letters,
            lambda x, i: F.struct(
                x.alias("enters"),
                F.when(i >= WINDOW, F.get(letters, i - WINDOW)).otherwise(F.lit(-1)).alias("leaves"),
                i.alias("place"),
            ),
        ),
    )
    # n * log2(n) for each count n that a window can hold.
    weight = F.array(*(F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(WINDOW + 2)))
    # Entropy = log2(WINDOW) - sum / WINDOW, so a threshold on it is one on the sum.
    most = math.floor((math.log2(WINDOW) - least) * WINDOW * UNIT)
    spans = "array<struct<start:int,end:int>>"

    def step(s: Column, m: Column) -> Column:
        x, y = m["enters"], m["leaves"]
        counted = F.get(s["counts"], x)
        before = F.get(s["counts"], y) + F.when(x == y, 1).otherwise(0)
        gained = F.get(weight, counted + 1) - F.get(weight, counted)
        lost = F.when(y >= 0, F.get(weight, before) - F.get(weight, before - 1)).otherwise(F.lit(0).cast("long"))
        total = s["total"] + gained - lost
        counts = F.transform(
            s["counts"], lambda c, k: c + F.when(k == x, 1).otherwise(0) - F.when(k == y, 1).otherwise(0)
        )
        start = m["place"] - (WINDOW - 1)
        hit = (start >= 0) & (total <= most)
        opens = hit & ((s["start"] < 0) | (start > s["end"]))
        closed = F.when(
            opens & (s["start"] >= 0),
            F.array_append(s["spans"], F.struct(s["start"].alias("start"), s["end"].alias("end"))),
        ).otherwise(s["spans"])
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(opens, start).otherwise(s["start"]).alias("start"),
            F.when(hit, m["place"] + 1).otherwise(s["end"]).alias("end"),
            closed.alias("spans"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(-1).alias("start"),
        F.lit(-1).alias("end"),
        F.array().cast(spans).alias("spans"),
    )
    last = F.aggregate(
        moves,
        zero,
        step,
        lambda s: F.when(
            s["start"] >= 0, F.array_append(s["spans"], F.struct(s["start"].alias("start"), s["end"].alias("end")))
        ).otherwise(s["spans"]),
    )
    number = F.lit(KINDS.index(kind))
    return F.transform(
        last,
        lambda p: F.struct(
            (p["start"] + shift).alias("start"), (p["end"] + shift).alias("end"), number.alias("kind")
        ),
    )


def _entropy_spans(text: Column, kind: str) -> Column:
    letters, _, _ = ENTROPY_KINDS[kind]
    pattern = f"{letters}{{{WINDOW},}}"
    suspects = F.filter(_places(text, pattern), lambda p: ~p["value"].rlike("|".join(f"(?:{a})" for a in ALLOWED)))
    spans = F.flatten(F.transform(suspects, lambda p: _entropy_of(p["value"], p["start"], kind)))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, in the order given."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: an array of (start, end, kind), by start, then kind as listed;
    ``kind`` is a number of ``KINDS``. A column of that name is replaced."""
    # The tables' own text is never scanned twice: the array is built once per row and kept.
    whole = F.coalesce(F.col(text), F.lit(""))
    found = F.concat(
        *(_base_spans(whole, kind) for kind in BASE_KINDS), *(_entropy_spans(whole, kind) for kind in ENTROPY_KINDS)
    )
    in_order = F.transform(
        F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["kind"], s["end"]))),
        lambda s: F.struct(s["start"], s["end"], s["kind"]),
    )
    return docs.withColumn(out, in_order)
