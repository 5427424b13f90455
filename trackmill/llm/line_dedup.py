"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Lines within k edits of each other share one of the k + 1 segments of the shorter one, at a place that the lengths and
the segment's number confine to a few. How many edits are allowed hangs on the shorter line's length, and no edit
touches a digit: lines with other digits say other things. Lines index their segments by length, number and digits and
look up the substrings at those places; lines that meet are verified with a banded bit-parallel edit distance. Where
very many lines share a segment, what is left of them beside it, which holds all the edits, is cut and looked up in the
same way. A line goes if it is itself within its edits of an earlier line that stays; lines that are linked to dropped
ones only stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import discard, scratch, written

#: (characters of the shorter line, edits): so many edits are allowed from so many characters on, none below the first.
BANDS = ((8, 1), (20, 2))
#: Entries under one key beyond which the rest of the lines is looked up as well.
HEAVY = 1000
#: A line that isn't blank.
NOT_BLANK = r"[^\n]*[^\x20\x09-\x0D\n][^\n]*"
#: What lines are trimmed of.
SPACES = " \t\n\x0b\f\r"
#: Letters that signatures count.
LETTERS = "eantirosdhlucmgpbfvw"
#: Line numbers or keys (8 bytes each) that are broadcast at most; more of them take a shuffle.
MOST_BROADCAST = 500_000


#: Numbers that lines may go by; the first that proves free of collisions on the lines at hand is used.
SEEDS = (0, 1, 2, 3)


def number(line: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), line)


def digits(line: Column) -> Column:
    """The digits of a line in order, of any script."""
    return F.when(F.rlike(line, F.lit(r"\p{Nd}")), F.regexp_replace(line, r"\P{Nd}+", "")).otherwise(F.lit(""))


def trimmed(line: Column) -> Column:
    """A line of a text without white space at its ends. Spark's trim of given characters goes through whole strings, so only lines that need it take it."""
    ends = reduce(or_, [f(line, F.lit(c)) for c in SPACES for f in (F.startswith, F.endswith)])
    return F.when(ends, F.btrim(line, F.lit(SPACES))).otherwise(line)


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, at, line): the lines of docs, trimmed, with their numbers from 0 in the text t; blank lines are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), _text_key(text).alias("t"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    return split.withColumn("line", trimmed(F.col("line"))).where("line != ''")


def _lookups(bands: Sequence[tuple[int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(least, most, k, shorter, i, shift): what a line looks up among lines that are shorter by so many characters.

    least and most bound the shorter line's length. Segment i of it, if unchanged, lies at most i before or after its
    own place counted from the left, and at most k - i counted from the right.
    """
    out = []
    for (least, k), most in zip(bands, [*[b[0] for b in bands[1:]], 1 << 30], strict=True):
        for shorter in range(k + 1):
            for i in range(k + 1):
                out += [(least, most, k, shorter, i, shift) for shift in range(max(-i, shorter - (k - i)), min(i, shorter + (k - i)) + 1)]
    return out


def _looked_up(rows: DataFrame, text: str, lookups: Sequence[tuple[int, ...]], *fixed: str) -> DataFrame:
    """rows with a row for each lookup that fits text, as (k, shorter, i, own, at, size, piece).

    piece is the substring of size characters from at (0 the first); own says that it is text's own segment, under which
    others find it. Columns in fixed must equal the lookup's. The lookups are exploded from a constant array, so that
    the plan has one expression for all of them.
    """
    names = ("least", "most", "k", "shorter", "i", "shift")
    said = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, x, strict=True)]) for x in lookups])
    out = rows.withColumn("length", F.length(text)).withColumn("p", F.explode(said))
    for c in fixed:
        out = out.where(F.col(c) == F.col(f"p.{c}"))
    short = F.col("length") - F.col("p.shorter")
    cut = lambda number: F.floor(short * number / (F.col("p.k") + 1)).cast("int")
    out = out.withColumns({"short": short, "at": cut(F.col("p.i")) + F.col("p.shift"), "size": cut(F.col("p.i") + 1) - cut(F.col("p.i"))})
    out = out.where((F.col("short") > 0) & (F.col("short") >= F.col("p.least")) & (F.col("short") < F.col("p.most")) & (F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("length")))
    kept = [c for c in rows.columns if c not in ("k", "shorter", "own", "at", "size")]
    piece = F.substring(F.col(text), F.col("at") + 1, F.col("size"))
    return out.select(*kept, "short", "p.k", "p.shorter", "p.i", ((F.col("p.shorter") == 0) & (F.col("p.shift") == 0)).alias("own"), "at", "size", piece.alias("piece"))


def entries(lines: DataFrame, bands: Sequence[tuple[int, int]] = BANDS) -> DataFrame:
    """(h1, line, key, own, k, shorter, at, size) of lines(h1, line): what each is indexed under (own) and looks up."""
    rows = _looked_up(lines.withColumn("d", F.xxhash64(digits(F.col("line")))), "line", _lookups(bands))
    return rows.select("h1", "line", F.xxhash64("short", "i", "d", "piece").alias("key"), "own", "k", "shorter", "at", "size")


def _let(value: Column, then) -> Column:
    """then of value, with value computed once; a bare reuse in a lambda would compute it at every step."""
    return F.transform(F.array(value), then)[0]


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _without_shared_ends(a: Column, b: Column, k: int) -> Column:
    """(a, b) without quarters that they begin or end with alike, which leaves their distance; long ones only."""

    def shared(x: Column, y: Column, end: bool) -> Column:
        n = F.least(F.length(x), F.length(y))
        out = F.when(n < 8 * (k + 1), 0)
        for quarters in (3, 2, 1):
            size = F.floor(n * quarters / 4).cast("int")
            same = F.right(x, size) == F.right(y, size) if end else F.left(x, size) == F.left(y, size)
            out = out.when(same, size)
        return out.otherwise(0)

    head = shared(a, b, False)
    cut = F.struct(F.substring(a, head + 1, F.length(a)).alias("a"), F.substring(b, head + 1, F.length(b)).alias("b"))

    def tail(pair: Column) -> Column:
        size = shared(pair["a"], pair["b"], True)
        return F.struct(F.left(pair["a"], F.length(pair["a"]) - size).alias("a"), F.left(pair["b"], F.length(pair["b"]) - size).alias("b"))

    return _let(cut, tail)


def edit_distance_within(a: Column, b: Column, k: int) -> Column:
    """Edit distance of two strings whose lengths differ by at most k, as far as k; greater ones are just above k.

    One pass over b keeps a band of 2k + 1 rows of the distance matrix as bits: at step j they stand for the rows j - k
    to j + k of a. The value at the band's lower edge is followed down to the last row of a and then along it. Needs
    more than k characters in a.
    """
    letters = lambda p: F.struct(F.split(p["a"], "").alias("x"), F.split(p["b"], "").alias("y"), F.length(p["a"]).alias("rows"), F.length(p["b"]).alias("columns"))
    return _let(_without_shared_ends(a, b, k), lambda p: _let(letters(p), lambda s: _banded(s["x"], s["y"], s["rows"], s["columns"], k)))


def _banded(x: Column, y: Column, rows: Column, columns: Column, k: int) -> Column:
    width = 2 * k + 1
    full = (1 << width) - 1

    def matches(j: Column, letter: Column) -> Column:
        out = _long(0)
        for r in range(width):
            out = out.bitwiseOR(F.when(F.get(x, j - k + r) == letter, _long(1 << r)).otherwise(_long(0)))
        return out

    def given(state: Column, d: Column, hp: Column, j: Column) -> Column:
        hn, down = d.bitwiseAND(state["vp"]), F.shiftright(d, 1)
        beyond = j - (rows - k)  # from 0 on the edge is a's last row
        bit = F.coalesce(F.get(F.array(*[_long(1 << r) for r in range(width - 2, -1, -1)]), F.greatest(beyond, F.lit(0))), _long(0))
        along = F.when(hp.bitwiseAND(bit) != 0, 1).when(hn.bitwiseAND(bit) != 0, -1).otherwise(0)
        edge = F.when(d.bitwiseAND(_long(1 << (width - 1))) == 0, 1).otherwise(0)
        step = F.when(beyond < 0, edge).otherwise(along)
        vp = hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(_long(full))
        return F.struct(vp.alias("vp"), down.bitwiseAND(hp).alias("vn"), (state["edits"] + step).alias("edits"))

    def advance(state: Column, j: Column) -> Column:
        def diagonal(m: Column) -> Column:
            vp = state["vp"]
            d = (m.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(m).bitwiseOR(state["vn"]).bitwiseAND(_long(full))
            return _let(d, horizontal)

        def horizontal(d: Column) -> Column:
            hp = state["vn"].bitwiseOR(F.bitwise_not(d.bitwiseOR(state["vp"]))).bitwiseAND(_long(full))
            return _let(hp, lambda hp: given(state, d, hp, j))

        # some row of the band is at most 2k from the edge, so beyond 3k none is within k and the rest is skipped
        return F.when(state["edits"] > 3 * k, state).otherwise(_let(F.get(y, j), lambda c: _let(matches(j, c), diagonal)))

    start = F.struct(_long(full & ~((1 << k) - 1)).alias("vp"), _long(0).alias("vn"), F.lit(k).alias("edits"))
    return F.aggregate(F.sequence(F.lit(0), columns - 1), start, advance, lambda s: s["edits"])


def letter_signature(line: Column) -> Column:
    """Counts of frequent letters modulo 4 in two bits each, so coded that a step of one changes one bit.

    An edit changes at most two counts by one, so lines within k edits differ in at most 2k bits.
    """
    out = _long(0)
    for i, letter in enumerate(LETTERS):
        count = F.length(line) - F.length(F.replace(line, F.lit(letter), F.lit("")))
        code = F.get(F.array(*[_long(g << (2 * i)) for g in (0, 1, 3, 2)]), count % 4)
        out = out.bitwiseOR(code)
    return out


def _within(a: Column, b: Column, bands: Sequence[tuple[int, int]]) -> Column:
    """Whether two lines are within the edits that the shorter one's length allows."""
    least, out = F.least(F.length(a), F.length(b)), F.lit(False)
    for chars, k in bands:
        near = (F.abs(F.length(a) - F.length(b)) <= k) & (edit_distance_within(a, b, k) <= k)
        out = F.when(least >= chars, near).otherwise(out)
    return out


def _few(table: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if a count finds it small."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def line_links(found: DataFrame, bands: Sequence[tuple[int, int]] = BANDS, heavy: int = HEAVY, seed: int = 0) -> DataFrame:
    """(a, b): numbers of different lines of found(line) within their edits, each pair once. Lines may repeat.

    First only keys are dealt out, and those that two lines share are found by partial aggregates, so a key of very many
    lines is no single task's. The texts of lines under these are fetched, their pairs formed under a condition on
    signatures, and the pairs verified. Keys of more than heavy entries are joined on a second key, a segment of the
    rest of the line, which loses no link.
    """
    long = found.where(F.length("line") >= bands[0][0]).select(number(F.col("line"), seed).alias("h1"), "line")
    tried = entries(long, bands)
    shared = tried.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.bool_or("own").alias("own"))
    shared = written(shared.where("own AND lo != hi").select("key"), "keys-shared")
    if shared.count() <= MOST_BROADCAST:  # lines take their texts along
        hits = written(tried.join(F.broadcast(shared), "key", "left_semi").distinct(), "line-hits")
        rows, texts = hits.drop("line"), written(hits.select("h1", "line").distinct(), "line-texts")
    else:
        rows = written(tried.drop("line").join(shared, "key", "left_semi").distinct(), "line-entries")
        texts = _texts(long, written(rows.select(F.col("h1").alias("met")).distinct(), "lines-met"))
    signed = written(texts.select("h1", letter_signature(F.col("line")).alias("sig")), "lines-signed")
    crowded = written(rows.groupBy("key").count().where(F.col("count") > heavy).select("key"), "keys-crowded")
    light, pairs = rows, None
    if not crowded.isEmpty():
        light = rows.join(_few(crowded), "key", "left_anti")
        pairs = _crowded_pairs(rows.join(_few(crowded), "key", "left_semi"), texts.join(signed, "h1"), bands)
    some = _pairs(light.select("h1", "key", "own", "k", "shorter").join(signed, "h1"), ["key"])
    pairs = written((some if pairs is None else some.unionByName(pairs)).distinct(), "line-pairs")
    left = texts.select(F.col("h1").alias("p"), F.col("line").alias("a"))
    right = texts.select(F.col("h1").alias("q"), F.col("line").alias("b"))
    near = (digits(F.col("a")) == digits(F.col("b"))) & _within(F.col("a"), F.col("b"), bands)
    out = written(pairs.join(left, "p").join(right, "q").where(near).select(F.col("p").alias("a"), F.col("q").alias("b")), "line-links")
    discard(shared, rows, signed, crowded, pairs)
    return out


def _crowded_pairs(dense: DataFrame, texts: DataFrame, bands: Sequence[tuple[int, int]]) -> DataFrame:
    """(p, q): lines that meet under a crowded key and a segment of what is left of them beside it.

    The rest holds all the edits that the key's own lengths allow, and is shorter by as much as the line.
    """
    rest = F.concat(F.substring("line", 1, F.col("at")), F.substring(F.col("line"), F.col("at") + F.col("size") + 1, F.length("line")))
    dense = dense.join(texts, "h1").select("h1", "sig", "key", F.col("own").alias("first"), "k", "shorter", rest.alias("rest"))
    dense = written(dense.withColumn("grams", bigram_signature(F.col("rest"))), "lines-crowded")
    lookups = sorted({(0, 1 << 30, *x[2:]) for x in _lookups(bands)})
    second = _looked_up(dense, "rest", lookups, "k", "shorter").withColumn("second", F.xxhash64("i", "piece"))
    rows = second.select("h1", "sig", "grams", "key", "second", (F.col("first") & F.col("own")).alias("own"), "k", "shorter")
    # a line under a key of its own also asks for lines of its own length
    near = F.bit_count(F.col("grams").bitwiseXOR(F.col("grams_q"))) <= 4 * F.col("k")
    return _pairs(rows, ["key", "second"], near)


def bigram_signature(line: Column) -> Column:
    """The parity of a line's letter pairs, hashed to 60 bits. An edit takes at most two pairs away and adds two."""
    letters, bits = F.split(line, ""), F.array(*[_long(1 << r) for r in range(60)])
    grams = F.zip_with(letters, F.slice(letters, 2, F.greatest(F.size(letters) - 1, F.lit(0))), lambda a, b: F.get(bits, F.pmod(F.hash(a, b), F.lit(60))))
    return F.aggregate(grams, _long(0), lambda x, g: x.bitwiseXOR(g))


def _pairs(rows: DataFrame, keys: list[str], near: Column | None = None) -> DataFrame:
    """(p, q): lines that meet under the keys, one of them by its own segment, and whose signatures are near enough."""
    asking = rows.withColumnsRenamed({"h1": "q", "sig": "sig_q", "grams": "grams_q", **{c: f"{c}_q" for c in keys}}).drop("own", "k")
    own = rows.where("own").drop("shorter")
    on = (F.lit(True) if near is None else near) & (F.col("h1") != F.col("q")) & (F.bit_count(F.col("sig").bitwiseXOR(F.col("sig_q"))) <= 2 * F.col("k"))
    for c in keys:
        on &= F.col(c) == F.col(f"{c}_q")
    return own.join(asking, on).select(F.least("h1", "q").alias("p"), F.greatest("h1", "q").alias("q"))


def _texts(lines: DataFrame, met: DataFrame) -> DataFrame:
    """(h1, line): the different lines whose h1 is in met, which are met in a shuffle after the copies are dropped."""
    return written(lines.distinct().join(met, F.col("h1") == F.col("met"), "left_semi"), "line-texts")


def stars(links: DataFrame, places: DataFrame) -> DataFrame:
    """(line, kept): the lines to drop and, of the lines that stay, the first that each is linked to.

    links(a, b) are between lines of places(line, place). Lines are gone through by place: one stays unless it is linked
    to an earlier one that stays. That is done in rounds: those without an earlier undecided neighbour stay, their
    neighbours go, and the rest is judged again. Each round is written; a chain of links that runs in the order of
    places takes as many rounds as half its length.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    placed = written(places.join(ends, "line", "left_semi"), "lines-placed")
    both = links.join(placed.select(F.col("line").alias("a"), F.col("place").alias("x")), "a").join(placed.select(F.col("line").alias("b"), F.col("place").alias("y")), "b")
    swap = F.col("y") < F.col("x")
    edges = written(both.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("early"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("late")), "edges")
    open_edges, stay = edges, []
    while True:
        late = open_edges.select(F.col("late").alias("line")).distinct()
        kept = written(open_edges.select(F.col("early").alias("line")).distinct().join(late, "line", "left_anti"), "lines-kept")
        stay.append(kept)
        gone = written(open_edges.join(kept.withColumnRenamed("line", "early"), "early", "left_semi").select(F.col("late").alias("line")).distinct(), "lines-dropped")
        left = open_edges
        for decided, end in ((kept, "early"), (gone, "early"), (gone, "late")):
            left = left.join(decided.withColumnRenamed("line", end), end, "left_anti")
        left = written(left, "edges-open")
        discard(gone, *([] if open_edges is edges else [open_edges]))
        open_edges = left
        if open_edges.isEmpty():
            break
    # an edge's early end that no round decided as a late one was kept in one; lines left without edges stay, and need no entry
    every = stay[0]
    for more in stay[1:]:
        every = every.unionByName(more)
    first = edges.join(written(every, "lines-stay").withColumnRenamed("line", "early"), "early", "left_semi")
    first = first.join(placed.withColumnRenamed("line", "early"), "early").groupBy("late").agg(F.min("place").alias("kept"))
    out = written(first.withColumnRenamed("late", "line"), "stars")
    discard(edges, open_edges, placed, *stay)
    return out


def _dropped(docs: DataFrame, id_col: str, text_col: str, bands: Sequence[tuple[int, int]]) -> DataFrame:
    """The lines to drop as (id, t, at, kept_in, near)."""
    found = lines(docs, id_col, text_col)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "t", "at")
    for seed in SEEDS:
        named = found.select("id", "t", "at", number(F.col("line"), seed).alias("line"), F.xxhash64(F.lit("line"), F.col("line")).alias("check"))
        named = written(named, "lines")
        groups = written(named.groupBy("line").agg(F.min(place).alias("place"), F.count("*").alias("n"), F.min("check").alias("lo"), F.max("check").alias("hi")), "lines-different")
        if groups.where("lo != hi").isEmpty():
            break
    else:
        raise ValueError("every line number has collisions")
    links = line_links(found, bands, seed=seed)
    near = stars(links, groups.select("line", "place")).select("line", F.col("kept").alias("first"), F.lit(True).alias("near"))
    copies = groups.where("n > 1").join(near, "line", "left_anti").select("line", F.col("place").alias("first"), F.lit(False).alias("near"))
    known = written(copies.unionByName(near), "repeated")
    gone = named.drop("check").join(known, "line").where(~place.eqNullSafe(F.col("first")))
    out = written(gone.select("id", "t", "at", F.col("first.id").alias("kept_in"), "near").distinct(), "lines-gone")
    discard(named, groups, links, known)
    return out


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Sequence[tuple[int, int]] = BANDS) -> DataFrame:
    """One row per different id and text of docs: id_col, n_lines, n_dropped, n_near, dropped (line, kept_in), by line.

    A line is dropped if an equal one, or one within its edits that stays, stands earlier, by id (null ids last), then
    text, then number; kept_in is the id with the first such one. n_near counts the dropped lines that differ from the
    one that stays. Lines with other digits are never near. Lines are compared trimmed;
    blank lines, and null and empty texts, count no lines and lose none. Rows that repeat id and text are one document,
    as are null and empty texts of one id; several texts of one id are several. Texts of one id are told apart by a
    64-bit hash. Lines under the first band's length match exactly only. Other columns of docs are not read.
    """
    gone = _dropped(docs, id_col, text_col, bands)
    dropped = gone.groupBy("id", "t").agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("line"), "kept_in"))).alias("dropped"), F.count_if("near").alias("n_near"))
    dropped = dropped.withColumnsRenamed({"id": "gone_id", "t": "gone_t"})
    out = docs.select(F.col(id_col).alias("id"), _text_key(F.col(text_col)).alias("t"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(NOT_BLANK)).cast("long").alias("n_lines")).distinct()
    out = out.join(dropped, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("t") == F.col("gone_t")), "left")
    lost = F.coalesce("dropped", F.array().cast(dropped.schema["dropped"].dataType))
    return out.select(F.col("id").alias(id_col), "n_lines", F.size(lost).cast("long").alias("n_dropped"), F.coalesce("n_near", F.lit(0)).alias("n_near"), lost.alias("dropped"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Sequence[tuple[int, int]] = BANDS) -> DataFrame:
    """docs with text_col rid of the lines that repeated_lines drops; other columns stay as they are.

    All rows stay, also those whose lines all go; rows that repeat id and text lose the same lines.
    """
    gone_id, gone_t, at = scratch(docs, "_gone_id"), scratch(docs, "_gone_t"), scratch(docs, "_gone")
    gone = _dropped(docs, id_col, text_col, bands).groupBy(F.col("id").alias(gone_id), F.col("t").alias(gone_t)).agg(F.collect_list("at").alias(at))
    out = docs.join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (_text_key(F.col(text_col)) == F.col(gone_t)), "left")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains(at, i)), "\n")
    return out.withColumn(text_col, F.when(F.col(at).isNotNull(), kept).otherwise(F.col(text_col))).select(*docs.columns)
