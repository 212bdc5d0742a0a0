"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Words are ordered from rare to frequent; two
sets with a Jaccard similarity of at least t must share a word in the first
n - ceil(t n) + 1 of both, which is the join key. Length and position of the
shared word rule most pairs out before any text is read; the rest are verified.
The shorter set of a pair is found by a shorter prefix, and words are joined together
with a band of lengths.
A line goes if an earlier one (by document id, then line number) is similar.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled, shuffles_dropped

_HASH_BITS = 48


def _spaced(text: str) -> str:
    """SQL for a text with spaces for all other ASCII white space but line breaks."""
    return f"replace(replace(replace(replace({text}, '\\t', ' '), '\\r', ' '), '\\u000c', ' '), '\\u000b', ' ')"


def _words(line: str) -> str:
    """SQL for the distinct words of a line."""
    return f"array_distinct(array_remove(split({_spaced(line)}, ' '), ''))"


def _double(number: float) -> str:
    """SQL for a number as double; a plain 0.8 is a decimal, whose arithmetic costs most of a pair's tests."""
    return f"{float(number)!r}D"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, line) of every line of documents with an id, its words parted by spaces alone."""
    text = F.expr(_spaced(_quoted(text_col))).alias("text")
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text)
    return rows.select("id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def word_ranks(docs: DataFrame, text_col: str = "text", cells: int = 1 << 18) -> bytes:
    """For each of ``cells`` hash cells, how often words of the corpus fall into it, in steps of a third of a power of two.

    All words of all texts are counted. The order of words by (step of the cell,
    hash) is the rarity order of the join: frequent words come last, and any
    consistent order gives exact results. One byte per cell, whatever the corpus.
    """
    words = docs.select(F.explode(F.split(F.replace(F.col(text_col), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(F.expr(f"cast(xxhash64(w) & {cells - 1} as int)").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    with shuffles_dropped(docs.sparkSession):
        steps = counts.select("cell", F.expr("cast(least(3 * log2(n), 126) as int)").alias("step")).toPandas()
    ranks = bytearray(cells)
    for cell, step in zip(steps["cell"].tolist(), steps["step"].tolist()):
        ranks[cell] = step
    return bytes(ranks)


def line_sets(docs: DataFrame, threshold: float, ranks: bytes, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, n, odd, prefix): the first line with each word set, its number of words, parities and prefix word hashes.

    ``odd`` tells for 64 classes of words whether the set holds an odd number of
    them. Lines without words are left out. Repeated sets are merged in each task
    before the shuffle, so a line that fills a third of the corpus is few rows.
    """
    hashes = "array_distinct(array_remove(transform(split(line, ' '), w -> xxhash64(w)), xxhash64('')))"
    # Functions with a lambda are interpreted node by node, so the table is an array, made once by the optimizer.
    table = f"cast(split('{','.join(map(str, ranks))}', ',') as array<int>)"
    rank = f"get({table}, cast(h & {len(ranks) - 1} as int))"
    keys = f"sort_array(transform(hashes, h -> shiftleft(cast({rank} as bigint), {_HASH_BITS}) | (h & {2**_HASH_BITS - 1})))"
    # Lines without words are found by their text: a filter on the keys would compute them twice.
    filled = _lines(docs, id_col, text_col).where("trim(line) != ''")
    # One projection each, or the words are made distinct inside of the next lambda; n is read here to keep them apart.
    hashed = filled.select("id", "pos", F.expr(hashes).alias("hashes"))
    keyed = hashed.select("id", "pos", F.size("hashes").alias("n"), F.expr(keys).alias("keys"))
    prefix = f"slice(keys, 1, n - cast(ceil({_double(threshold)} * n - 1e-9) as int) + 1)"
    odd = "aggregate(keys, 0L, (a, k) -> a ^ shiftleft(1L, cast(shiftright(k, 24) as int)))"  # shifts count modulo 64
    first = F.struct(
        "id", "pos", "n", F.expr(odd).alias("odd"), F.expr(f"transform({prefix}, k -> hash(k))").alias("prefix")
    )
    rows = keyed.select(F.expr("xxhash64(keys)").alias("sa"), F.expr("xxhash64(keys, 1)").alias("sb"), first.alias("r"))
    return rows.groupBy("sa", "sb").agg(F.min("r").alias("r")).select("r.*")


def _met(x: DataFrame, y: DataFrame, threshold: float, apart: str) -> DataFrame:
    """Pairs of rows (k, id, pos, i, n, odd) that share the key k, fulfil ``apart`` and pass all filters.

    Length: the smaller set has at least ``threshold`` of the larger's words.
    Position: what comes before and after the shared word leaves room for the
    overlap; at the first shared word what follows it alone.
    Parity: sets that differ in more classes than in allowed words are too far
    apart. ``n`` of a line that needs no partner is negative.
    """
    t = _double(threshold)
    most = f"floor({_double((1 - threshold) / (1 + threshold))} * (abs(x.n) + abs(y.n)) + 1e-9)"
    return x.alias("x").join(y.alias("y"), F.col("x.k") == F.col("y.k")).where(
        f"{apart} AND bit_count(x.odd ^ y.odd) <= {most} "
        f"AND abs(x.n) >= {t} * abs(y.n) - 1e-9 AND abs(y.n) >= {t} * abs(x.n) - 1e-9 "
        f"AND least(x.i, y.i) + least(abs(x.n) - x.i, abs(y.n) - y.i) >= {_need(threshold)}"
    )


def _need(threshold: float) -> str:
    """SQL for the least overlap of similar sets x and y."""
    return f"ceil({_double(threshold / (1 + threshold))} * (abs(x.n) + abs(y.n)) - 1e-9)"


def _followers(pivots: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the pivot of a word and a later line that has the word."""
    met = _met(pivots, rows, threshold, "(x.id < y.id OR (x.id = y.id AND x.pos < y.pos))")
    return met.select(*[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in "xy" for c in ("id", "pos")]).distinct()


def _pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (x earlier, y later) of lines (id, pos, n, odd, prefix) that share a prefix word and pass all filters; y needs a partner.

    In the join x is the longer line, or the later one of equal length. The
    overlap is then at least 2t / (1 + t) of the shorter one's words, so y is
    found by a shorter prefix. The key is the word with a band of lengths: x lies
    in one band, y in the one or two its longer partners may lie in.

    Count: a word of one prefix can be shared with the other set only inside the
    other prefix, if that ends later; so the overlap is at most the number of
    shared prefix words and what follows the longer rest, and pairs that share
    too few are out.
    """
    step = max(-3 * math.log(threshold), 1e-6)  # a third of the short ones lie in two bands
    band = lambda n: f"cast(floor(ln({n}) / {_double(step)}) as bigint)"  # noqa: E731  monotone, so both sides agree
    t, shorter = _double(threshold), _double(2 * threshold / (1 + threshold))
    short = f"ceil({shorter} * abs(n) - 1e-9)"
    columns = ["id", "pos", "n", "odd"]
    bands = f"sequence({band('abs(n)')}, {band(f'floor(abs(n) / {t} + 1e-9)')})"
    part = f"slice(prefix, 1, cast(abs(n) - {short} as int) + 1)"
    x = sets.select(*columns, "prefix", F.expr(band("abs(n)")).alias("band"))
    y = sets.select(*columns, F.expr(part).alias("prefix"), F.explode(F.expr(bands)).alias("band"))
    key = F.expr(f"shiftleft(band, 32) | (k & {2**32 - 1}L)").alias("k")
    x, y = (e.select(*columns, "band", F.posexplode("prefix").alias("i", "k")).select(*columns, "i", key) for e in (x, y))
    later = "(x.id > y.id OR (x.id = y.id AND x.pos > y.pos))"
    apart = f"(abs(x.n) > abs(y.n) OR (abs(x.n) = abs(y.n) AND {later})) AND if({later}, x.n, y.n) > 0"
    met = _met(x, y, threshold, apart)
    both = [F.expr(f"if({later}, {b}.{c}, {a}.{c})").alias(f"{e}_{c}") for e, a, b in ("xxy", "yyx") for c in ("id", "pos")]
    rest = f"greatest(ceil({t} * abs(x.n) - 1e-9), ceil({shorter} * abs(y.n) - 1e-9)) - 1"
    least = F.expr(f"cast({_need(threshold)} - ({rest}) as int)").alias("least")
    room = F.expr(f"cast(least(abs(x.n) - x.i, abs(y.n) - y.i) - {_need(threshold)} as int)").alias("room")  # most at the first
    keys = ["x_id", "x_pos", "y_id", "y_pos"]
    sums = [F.count(F.lit(1)).alias("shared"), F.max("least").alias("least"), F.max("room").alias("room")]
    return met.select(*both, least, room).groupBy(*keys).agg(*sums).where("shared >= least AND room >= 0").select(*keys)


def _verified(pairs: DataFrame, docs: DataFrame, threshold: float, id_col: str, text_col: str, most_broadcast: int) -> DataFrame:
    """(id, pos) of the later line of each pair (x earlier, y later) whose word sets reach the threshold."""
    ends = [pairs.select(F.col(f"{e}_id").alias("id"), F.col(f"{e}_pos").alias("pos")) for e in "xy"]
    needed = ends[0].unionAll(ends[1]).distinct().groupBy("id").agg(F.collect_list("pos").alias("wanted"))
    with shuffles_dropped(docs.sparkSession):
        few = pairs.count() <= most_broadcast
    if few:
        needed = F.broadcast(needed)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The wanted lines of one document, bounded by its own length; the text is split once, as a variable of the lambda.
    picked = "transform(array(split(text, '\\n')), lines -> transform(wanted, p -> struct(p as pos, get(lines, p) as line)))[0]"
    lines = rows.join(needed, "id").select("id", F.expr(f"inline({picked})"))
    sets = lines.where("line IS NOT NULL").select("id", "pos", F.expr(_words("line")).alias("words"))
    for e in "xy":
        pairs = pairs.join(sets.select(*[F.col(c).alias(f"{e}_{c}") for c in sets.columns]), [f"{e}_id", f"{e}_pos"])
    shared = "size(array_intersect(x_words, y_words))"
    return (
        pairs.where(f"{_double(1 + threshold)} * {shared} >= {_double(threshold)} * (size(x_words) + size(y_words)) - 1e-9")
        .select(F.col("y_id").alias("id"), F.col("y_pos").alias("pos")).distinct()
    )


def kept_lines(
    docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    hot: int = 256, most_broadcast: int = 1_000_000,
) -> DataFrame:
    """(id, pos) of the first line with each word set that no earlier line is similar to.

    ``hot``: words that share a hash cell with at least so many prefix entries go
    through a first round, in which every line is compared with the earliest one
    that has the word. That decides most lines of large groups of near copies in
    linear work; the full join then only looks for partners of undecided lines,
    among all lines. The round never changes the result.

    ``most_broadcast``: up to so many candidate pairs, the ids of their documents
    are sent to the scan that fetches the lines; beyond, the texts are shuffled.
    """
    sets = settled(line_sets(docs, threshold, word_ranks(docs, text_col), id_col, text_col))
    entries = sets.select("id", "pos", "n", "odd", F.posexplode("prefix").alias("i", "k"))
    cells = 1 << 18
    cell = f"(k & {cells - 1})"
    counts = entries.groupBy(F.expr(cell).alias("c")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot)
    with shuffles_dropped(docs.sparkSession):
        busy = counts.select("c").toPandas()["c"].tolist()  # at most one per cell, a fixed number
    decided, signed = None, sets
    if busy:
        marks = bytearray(cells)
        for c in busy:
            marks[c] = 1
        rows = entries.where(F.expr(f"substring(X'{marks.hex()}', {cell} + 1, 1) = X'01'"))
        pivots = rows.groupBy("k").agg(F.min(F.struct("id", "pos", "n", "odd", "i")).alias("p")).select("k", "p.*")
        first = settled(_followers(pivots, rows, threshold))
        decided = settled(_verified(first, docs, threshold, id_col, text_col, most_broadcast))
        marked = sets.join(decided.withColumn("done", F.lit(True)), ["id", "pos"], "left")
        signed = marked.withColumn("n", F.when(F.col("done").isNull(), F.col("n")).otherwise(-F.col("n")))
    pairs = settled(_pairs(signed, threshold))
    gone = _verified(pairs, docs, threshold, id_col, text_col, most_broadcast)
    if decided is not None:
        gone = gone.unionAll(decided).distinct()
    return sets.select("id", "pos").join(gone, ["id", "pos"], "left_anti")


def dedup_lines(
    docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """All rows and columns of ``docs``, the text without lines similar to an earlier one, plus line counts.

    ``__lines`` and ``__removed`` count the lines of the text and those taken
    out; columns of these names in ``docs`` are replaced. Lines without words stay. A null text and a row with a null id stay as
    they are, with counts 0, and take no part; rows that repeat an id are
    versions of one document and keep the same line numbers. Removed lines still
    count as earlier ones.
    """
    kept = kept_lines(docs, threshold, id_col, text_col, **options)
    by_doc = kept.groupBy("id").agg(F.collect_list("pos").alias("kept"))
    rows = docs.select(F.struct("*").alias("row"))
    met = rows.join(by_doc, F.col(f"row.{_quoted(id_col)}") == F.col("id"), "left")
    # Kept lines are fetched by number from the text split once, as a variable of the lambda: linear in the lines.
    # Only lines that are not kept can be blank; a document that loses none keeps its text as it is.
    rest = "array_except(sequence(0, size(s) - 1), kept)"
    blank = f"filter({rest}, i -> trim({_spaced('s[i]')}) = '')"
    left = "transform(array_sort(array_union(filter(kept, i -> i < size(s)), blank)), i -> s[i])"
    text = F.expr(f"row.{_quoted(text_col)}")
    whole = f"struct(row.{_quoted(text_col)} as text, size(s) as lines, 0 as removed)"
    less = f"transform(array({left}), l -> struct(array_join(l, '\\n') as text, size(s) as lines, size(s) - size(l) as removed))[0]"
    cut = F.expr(
        f"transform(array(split(row.{_quoted(text_col)}, '\\n')), s -> transform(array({blank}), blank -> "
        f"if(size(blank) = size({rest}), {whole}, {less}))[0])[0]"
    )
    some = F.col(f"row.{_quoted(id_col)}").isNotNull() & text.isNotNull()
    done = met.select("row", F.coalesce("kept", F.expr("cast(array() as array<int>)")).alias("kept"))
    done = done.select("row", F.when(some, cut).alias("cut"))
    own = [c for c in docs.columns if c not in ("__lines", "__removed")]
    return done.select(
        *[F.coalesce("cut.text", text).alias(c) if c == text_col else F.col(f"row.{_quoted(c)}").alias(c) for c in own],
        F.coalesce("cut.lines", F.lit(0)).alias("__lines"),
        F.coalesce("cut.removed", F.lit(0)).alias("__removed"),
    )
