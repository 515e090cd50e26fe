"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Only DataFrame and SQL functions. A text is cut into paragraphs at words that their own hash chooses, one in ``EVERY`` whatever
the length of the text, so that equal passages give equal paragraphs; digests and sketches grow with the text. The digest of
a paragraph goes into one cell of each of three tables; a cell keeps a count, the XOR of its digests and the XOR of their check values. Sketches of
equal size subtract cell by cell, and equal digests cancel. A cell that then holds a single digest shows it; taking that out of
its other cells (peeling) shows more, until the digests by which the two texts differ are known. If the fingerprints' own
sketches do not peel, larger ones are tried until they do, the first so wide that its first table alone mostly shows all digests; the likeness of
two texts always comes from peeled digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.llm.common import checkpointed, table

TABLES = 3
BITS = 21  # of a digest that place it in each table
ROUNDS = 12  # of peeling, at most
PEELS = 2.45  # digests that three tables show for each cell of one of them, at most
WIDE = 1024  # cells of a table of a larger sketch for each digest of both texts
EVERY = 8  # words of a paragraph on average, in every text
END = "\u0001"
FULL = "x -> x.c <> 0 or x.k <> 0 or x.s <> 0"  # a cell that is not empty
RUN = "sequence(a, get(ends, j) - 1)"
FOUND = "array<struct<k:bigint,c:int>>"


def digests(text: Column) -> Column:
    """The different digests of a text's paragraphs. A text without words has none."""
    words = F.split(text, "\\s+")
    ends = lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(EVERY)) == 0, F.concat(w, F.lit(END))).otherwise(w)
    pieces = F.split(F.array_join(F.transform(words, ends), " "), f" ?{END} ?")
    return F.array_distinct(F.transform(F.filter(pieces, lambda p: F.trim(p) != ""), lambda p: F.xxhash64(p)))


# The expressions below are SQL texts: they have many small nodes, and the parser makes them at once.


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once. Unlike ``transform``, the end of an ``aggregate`` does not copy its result."""
    return f"aggregate(array(), {value}, (same, none) -> same, {name} -> {body})"


def placed(ds: str, width: str, count: str, digest: str) -> str:
    """The entries of an array: a cell (p, c, k, s) in each table for each element d, by the SQL of its ``count`` and ``digest``."""
    at = lambda of: f"int(shiftrightunsigned({digest}, {BITS * of}) & ({width} - 1)) + {of} * {width}"
    one = lambda of: f"transform({ds}, d -> named_struct('p', {at(of)}, 'c', {count}, 'k', {digest}, 's', xxhash64({digest})))"
    return f"concat({', '.join(map(one, range(TABLES)))})"


def by_place(of: str, place: str, one: str, many: str) -> str:
    """For each place that elements x of the array ``of`` have, in order: ``one`` of an element that is alone there, else ``many``.

    Numbers that hold place and index are put in order (``qs``), and by them the elements (``xs``). Those of a place start at ``a``; ``RUN``
    has the positions of all. Structs are made for a place and not for an element, as they cost most here.
    """
    qs = f"sort_array(transform({of}, (x, i) -> shiftleft({place}, 32) | i))"
    xs = f"transform(qs, q -> get({of}, int(q & 4294967295L)))"
    starts = "filter(transform(qs, (q, i) -> i), i -> i = 0 or shiftright(get(qs, i) ^ get(qs, i - 1), 32) <> 0)"
    each = f"transform(starts, (a, j) -> case when get(ends, j) = a + 1 then {one} else {many} end)"
    return let("qs", qs, let("xs", xs, let("starts", starts, let("ends", "concat(slice(starts, 2, size(qs)), array(size(qs)))", each))))


def total(of: str, zero: str, op: str, x: str) -> str:
    """A sum of SQL ``x`` over the elements x of an array."""
    return f"aggregate({of}, {zero}, (acc, x) -> acc {op} {x})"


def added(c: str, k: str, s: str) -> str:
    """The sums of counts, digests and check values of the elements of a place, each by SQL of its position x, to follow in a struct."""
    return ", ".join(f"{n!r}, {total(RUN, zero, op, x)}" for n, zero, op, x in (("c", "0", "+", c), ("k", "0L", "^", k), ("s", "0L", "^", s)))


def summed(entries: str) -> str:
    """The cells that entries add up to, in the order of their places; cells that are empty again are left out."""
    many = f"named_struct('p', get(xs, a).p, {added('get(xs, x).c', 'get(xs, x).k', 'get(xs, x).s')})"
    return let("es", entries, f"filter({by_place('es', 'bigint(x.p)', 'get(xs, a)', many)}, {FULL})")


def signed(a: str, b: str, body: str) -> str:
    """``body`` with the digests of ``a`` and then ``b`` as ``ds``, and how many of them count 1 as ``plus``; others count -1."""
    return let("plus", f"size({a})", let("ds", f"concat({a}, {b})", body))


def sign(at: str) -> str:
    return f"case when get(qs, {at}) & 4294967295L < plus then 1 else -1 end"


def cells(ds: str, width: str, one: Callable[[str], str]) -> str:
    """Three tables of ``width`` cells each, end to end, of the digests ``ds``; ``one`` is the SQL of a digest's count from its position."""

    def one_table(of: int) -> str:
        p = f"int(shiftright(get(qs, a), 32)) + {of} * {width}"
        alone = f"named_struct('p', {p}, 'c', {one('a')}, 'k', get(xs, a), 's', xxhash64(get(xs, a)))"
        many = f"named_struct('p', {p}, {added(one('x'), 'get(xs, x)', 'xxhash64(get(xs, x))')})"
        return by_place(ds, f"(shiftrightunsigned(x, {BITS * of}) & mask)", alone, many)

    return let("mask", f"bigint({width} - 1)", f"concat({', '.join(map(one_table, range(TABLES)))})")


def sketch(ds: str, width: str) -> str:
    """Three tables of ``width`` cells each, end to end: those that are not empty."""
    return cells(ds, width, lambda at: "1")


def folded(cells: str, width: str, narrow: str) -> str:
    """The sketch of a smaller width (powers of two), from a larger one: cells that then share a place are added."""
    moved = f"transform({cells}, x -> named_struct('p', int(x.p div {width} * {narrow} + pmod(x.p, {narrow})), 'c', x.c, 'k', x.k, 's', x.s))"
    return f"case when {width} > {narrow} then {summed(moved)} else {cells} end"


def subtract(a: str, b: str) -> str:
    """Cell by cell; sketches of equal width."""
    return summed(f"concat({a}, transform({b}, x -> named_struct('p', x.p, 'c', -x.c, 'k', x.k, 's', x.s)))")


def peel(diff: str, width: str) -> str:
    """The digests left in a difference as an array of (k, c), c 1 or -1 by the side it is on; null if they do not all come out."""
    single = "filter(st.t, x -> abs(x.c) = 1 and xxhash64(x.k) = x.s)"
    side = lambda c: f"transform(array_distinct(transform(filter(single, x -> x.c = {c}), x -> x.k)), k -> named_struct('k', k, 'c', {c}))"
    # every digest is in the first table: if its sums are those of what was found, nothing is left, and no cell needs to be added up
    same = (("0", "+", "x.c", "x.c"), ("0L", "^", "x.k", "x.k"), ("0L", "^", "x.s", "xxhash64(x.k)"))
    all_found = let("top", f"filter(st.t, x -> x.p < {width})", " and ".join(f"{total('top', zero, op, x)} = {total('found', zero, op, y)}" for zero, op, x, y in same))
    rest = f"case when {all_found} then slice(st.t, 1, 0) else {summed(f'concat(st.t, {placed("found", width, "-d.c", "d.k")})')} end"
    more = f"named_struct('t', {rest}, 'out', concat(st.out, found), 'done', false)"
    step = let("single", single, let("found", f"concat({side(1)}, {side(-1)})", f"case when size(found) > 0 then {more} else named_struct('t', st.t, 'out', st.out, 'done', true) end"))
    start = f"named_struct('t', {diff}, 'out', cast(array() as {FOUND}), 'done', false)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (st, r) -> case when st.done or size(st.t) = 0 then st else {step} end, st -> case when size(st.t) = 0 then st.out end)"


def power(x: str) -> str:
    """The least power of two that is ``x`` or more."""
    return f"cast(pow(2.0D, ceil(log2({x}))) as int)"


def width_of(ds: str) -> str:
    """The width of the fingerprint of these digests: its three tables hold half to all as many cells as there are digests."""
    return power(f"greatest(size({ds}), 24) / 6")


def digests_apart(diff: str, excess: str, width: str) -> str:
    """About how many digests differ: the mean squared sum of a table's counts, less what ``excess`` more digests on one side add."""
    squares = f"aggregate({diff}, 0.0D, (n, x) -> n + double(x.c) * x.c)"
    return f"({squares} / {TABLES} - double({excess}) * ({excess}) / {width}) * {width} / ({width} - 1)"


def roughly_apart(a: str, b: str) -> str:
    """Roughly how many digests differ, before any sketch: the mean of squared sums of +1 and -1 by a bit of each digest, over six bits.

    Three bits a number are counted at once, 20 bits apart; past a million digests counts run into each other, and only the guess is worse.
    """
    three = lambda ds, at: f"aggregate({ds}, 0L, (acc, d) -> acc + (shiftrightunsigned(d, {at}) & {1 | 1 << 20 | 1 << 40}L))"
    counts = lambda ds: let("two", f"array({three(ds, 5)}, {three(ds, 13)})", "transform(sequence(0, 5), n -> shiftrightunsigned(get(two, n div 3), 20 * (n % 3)) & 1048575L)")
    off = f"zip_with({counts(a)}, {counts(b)}, (x, y) -> 2.0D * (x - y) - (size({a}) - size({b})))"
    return f"aggregate({off}, 0.0D, (n, x) -> n + x * x) / 6"


def first_table(a: str, b: str, width: str) -> str:
    """What the first table of the sketch of ``a`` less that of ``b`` shows at once, as ``peel`` gives it; null if that is not all.

    A cell that one entry is in shows it; the others are added up and show a digest if one is left. All have come out if the sums of
    the table (those of all entries) are those of what was found.
    """
    pure = "case when abs(x.c) = 1 and xxhash64(x.k) = x.s then named_struct('k', x.k, 'c', x.c) end"
    many = let("x", f"named_struct({added(sign('x'), 'get(xs, x)', 'xxhash64(get(xs, x))')})", pure)
    shown = by_place("ds", "(x & mask)", f"named_struct('k', get(xs, a), 'c', {sign('a')})", many)
    same = (("0L", "^", "x.k", "x"), ("0L", "^", "xxhash64(x.k)", "xxhash64(x)"))
    all_found = " and ".join([f"{total('found', '0', '+', 'x.c')} = 2 * plus - size(ds)", *(f"{total('found', zero, op, x)} = {total('ds', zero, op, y)}" for zero, op, x, y in same)])
    return signed(a, b, let("mask", f"bigint({width} - 1)", let("found", f"filter({shown}, x -> x is not null)", f"case when {all_found} then found end")))


def larger(a: str, b: str, width: str) -> str:
    """What ``peel`` finds between two arrays of digests with sketches of ``width`` or, until they peel, of twice as much.

    The second sketch is subtracted as it is made: its digests count -1 each.
    """
    diff = signed(a, b, f"filter({cells('ds', 'big.w', sign)}, {FULL})")
    step = f"case when big.out is not null then big else named_struct('w', 2 * big.w, 'out', {peel(diff, 'big.w')}) end"
    return f"aggregate(sequence(1, {BITS}), named_struct('w', {width}, 'out', cast(null as {FOUND})), (big, n) -> {step}, big -> big.out)"


def with_differences(rows: DataFrame, pairs: dict[str, tuple[str, str, str, str]]) -> DataFrame:
    """``rows`` and, by its name, a column of the digests by which each pair differs: (digests, digests, difference of their
    sketches, its width).

    The fingerprints' own sketches are subtracted and peeled, unless more digests seem to differ than they can show. Those that are left
    get larger sketches. Empty cells cost nothing, so these are so wide that nearly all digests are alone in a cell: mostly the
    first table shows all that differ, and the others are made only where it does not. Widths grow until all digests come out. Each
    step is a column of its own, so that what several of its uses share is computed once.
    """
    columns = lambda some: rows.withColumns({n: F.expr(x) for n, x in some.items()})
    rows = columns({f"{n}_{k}": x for n, (a, b, _, width) in pairs.items() for k, x in (("rough", roughly_apart(a, b)), ("w", width))})
    rows = columns({f"{n}_diff": f"case when {n}_rough <= {TABLES} * {n}_w then {diff} end" for n, (_, _, diff, _) in pairs.items()})
    rows = columns({f"{n}_guess": digests_apart(f"{n}_diff", f"size({a}) - size({b})", f"{n}_w") for n, (a, b, _, _) in pairs.items()})
    rows = columns({f"{n}_first": f"case when {n}_guess <= {PEELS} * {n}_w then {peel(f'{n}_diff', f'{n}_w')} end" for n in pairs})
    rows = columns({f"{n}_wide": f"least({1 << BITS}, {power(f'greatest(size({a}) + size({b}), 8) * {WIDE}')})" for n, (a, b, _, _) in pairs.items()})
    rows = columns({f"{n}_shown": f"case when {n}_first is null then {first_table(a, b, f'{n}_wide')} else {n}_first end" for n, (a, b, _, _) in pairs.items()})
    return columns({n: f"case when {n}_shown is null then {larger(a, b, f'{n}_wide')} else {n}_shown end" for n, (a, b, _, _) in pairs.items()})


def likeness(a: str, b: str, differing: str) -> str:
    """The share of the digests of two texts that both have, 0 to 1, from those that differ; 1 if neither has any."""
    n, d = f"(size({a}) + size({b}))", f"size({differing})"
    return f"case when {n} = 0 then 1.0D else double(({n} - {d}) / ({n} + {d})) end"


def written_out(ds: str, cells: str, width: str) -> str:
    """A sketch as a string: how many digests, the width, then place, count, XOR of digests and of check values of each cell."""
    shown = "concat_ws(':', string(x.p), string(x.c), hex(x.k), hex(x.s))"
    return f"concat_ws(';', string(size({ds})), string({width}), array_join(transform({cells}, x -> {shown}), ','))"


def next_ids(keys: DataFrame) -> DataFrame:
    """(key, next_key) of a table of different keys: the next in ascending order, the first after the last.

    Keys are dealt by ranges; each range is ordered on its own, and the first keys of the ranges (one row a partition) join them.
    """
    ranged = checkpointed(keys.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    from pyspark.sql import Window

    firsts = ranged.groupBy("part").agg(F.min("key").alias("first"))
    firsts = firsts.select("part", F.lead("first").over(Window.orderBy("part")).alias("after"), F.min("first").over(Window.partitionBy()).alias("lowest"))
    inner = ranged.withColumn("next_key", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    return inner.join(F.broadcast(firsts), "part").select("key", F.coalesce("next_key", "after", "lowest").alias("next_key"))


def edited_fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document's.
    The next document is the row of the next larger id (after the largest: the smallest; null ids come first); of several rows of
    that id, the one whose replaced part, then digests, are smallest. Rows that repeat an id have the same next document. A null
    text is empty. A single document is its own next one. Equal texts have equal fingerprints.
    """
    id_of = docs.schema[doc_id].dataType
    zero = F.lit("" if id_of.typeName() == "string" else 0).cast(id_of)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(F.col(doc_id).isNotNull().alias("has"), F.coalesce(F.col(doc_id), zero).alias("id")).alias("key"), body.alias("text"), F.char_length(body).alias("n")
    )
    own = rows.select("key", "n").distinct()
    links = own.join(next_ids(own.select("key").distinct()), "key").select(F.col("next_key").alias("key"), F.col("key").alias("before"), F.col("n").alias("n_before"))
    dealt = rows.repartition("key")
    handed = dealt.join(links, "key").select(
        F.col("before").alias("key"),
        "n_before",
        F.struct(
            F.left("text", F.floor(F.col("n_before") / 4).cast("int")).alias("head"),
            digests(F.col("text")).alias("digests"),
            F.col("n").alias("n"),
        ).alias("next"),
    )
    handed = handed.repartition("key").groupBy("key", "n_before").agg(F.min("next").alias("next"))
    both = dealt.join(handed, (dealt["key"] == handed["key"]) & (dealt["n"] <= handed["n_before"]) & (dealt["n"] >= handed["n_before"])).drop(handed["key"])
    both = both.withColumn("edited", F.concat(F.left("text", F.col("n") - F.floor(F.col("n") / 4).cast("int")), F.col("next.head")))
    out = both.select(
        F.when(F.col("key.has"), F.col("key.id")).alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("changed"),
        F.col("next.digests").alias("after"),
    )
    out = out.withColumns({"own_width": F.expr(width_of("own")), "changed_width": F.expr(width_of("changed"))})
    out = out.withColumns({"own_tables": F.expr(sketch("own", "own_width")), "changed_tables": F.expr(sketch("changed", "changed_width"))})
    common = "least(own_width, changed_width)"
    edit = subtract(folded("own_tables", "own_width", common), folded("changed_tables", "changed_width", common))
    out = with_differences(out, {"edit": ("own", "changed", edit, common), "next": ("own", "after", summed(f"concat(own_tables, {placed('after', 'own_width', '-1', 'd')})"), "own_width")})
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.expr(written_out("own", "own_tables", "own_width")).alias("fingerprint"),
        F.expr(written_out("changed", "changed_tables", "changed_width")).alias("edited_fingerprint"),
        F.expr(likeness("own", "changed", "edit")).alias("near_edited"),
        F.expr(likeness("own", "after", "next")).alias("near_next"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and of its edited text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
