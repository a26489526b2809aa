"""Near-duplicate lines across documents, in DataFrame and SQL functions only.

A line's set has the ``CHARACTERS`` characters from the beginning of each of its words on
(words in lower case, between blanks; shorter at the end of the line), and from every further
character of a word with more of them, as far as the word goes: links, fields between tabs,
sentences in scripts without blanks. So each character of a line counts. Lines whose
sets have a Jaccard similarity of at least ``PERCENT`` per cent are linked, each component
of links is one line in several wordings, and only its first occurrence stays.

1. Shingles are exploded and hashed once, inside generated code. Each band has a hash of that hash,
   whose upper and lower halves are two independent MinHash values, also for lines of few shingles.
   The aggregate that finds the least ones also makes equal lines one row.
2. A pair just at the threshold agrees in none of ``BANDS`` bands of two values with a chance
   of (1 - 0.8 ** 2) ** 8 = 0.03 %. Lines of a band are a list; lists of one line are no candidates.
3. Sets are compared exactly: first each line with the centres of each of its lists. A list of n has
   up to ``CENTRES`` of them, or sqrt(n) / ``CENTRES``, less than n: of equal shares of its lines, each one that shares its
   lists with the most others. A line similar to many of a list is nearly always similar to a centre,
   so few links are left for the next step, which are n squared in a list of near copies. It
   compares the other lines of a list, those outside of its largest part so far with those of other
   parts. Both sides are cut into blocks, each pair of blocks being a key of its own;
   similarity is part of the join condition, so only links leave the join. Lines that share no
   list never meet, so the work follows the lists and not the components that they form.
4. Links become components by alternating stars (``common.components``).

Lines that are equal but for case and outer blanks need no shingles: they are one node.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import components, drop_stored, stored

CHARACTERS, PERCENT = 16, 80
BANDS = 8
# Least number of centres of a list, and what divides the root of its length where that gives more.
CENTRES = 4
# Long words are cut after so many characters, each piece with as much of the next as its shingles need.
PIECE = 64
# Longs of the filter that keeps lines of lists, 16 million bits.
FILTER_WORDS = 2**18
# Shingles of a list in one block.
BLOCK_SHINGLES = 100_000
# Tells the texts of a repeated id apart.
TEXT = "xxhash64(text)"


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank, with its text's hash, its number from 0 and its 128-bit name."""
    lines = docs.select("doc_id", F.expr(TEXT).alias("of"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # No letter is lost in lower case: blank lines go before the others are made small, once.
    lines = lines.where(F.trim("line") != "").select("doc_id", "of", "line_no", F.lower(F.trim("line")).alias("line"))
    return lines.withColumns({"h1": F.expr("xxhash64(line)"), "h2": F.expr("xxhash64(line, 1)")})


def _single(line: str) -> str:
    """A line with one blank between its words."""
    return f"if(contains({line}, '  '), regexp_replace({line}, '  +', ' '), {line})"


def _begun(line: str) -> str:
    """The characters from each word of a line of single blanks on, as many as a shingle has, in one scan.

    Of eight words of one character each, the blank that follows does not count.
    """
    return f"regexp_extract_all({line}, '(?s)(?=((?:[^ ] ){{7}}[^ ](?= )|.{{1,{CHARACTERS}}}))[^ ]+ ?', 1)"


def _has_long(line: str) -> str:
    """Whether a line of single blanks has a word of more characters than a shingle; each is looked at once."""
    return f"{line} RLIKE '^(?:[^ ]{{0,{CHARACTERS}}}+ )*+[^ ]{{{CHARACTERS + 1}}}'"


def _parts(line: str) -> str:
    """What the shingles of a line of single blanks are cut from: its words' beginnings, long words in pieces."""
    return f"if({_has_long(line)}, concat({_begun(line)}, {_pieces(line)}), {_begun(line)})"


def _pieces(line: str) -> str:
    """The long words of a line in pieces that have all of their shingles; time and memory linear in its length."""
    pattern = f"(?=([^ ]{{{CHARACTERS},{PIECE + CHARACTERS - 1}}}))[^ ]{{1,{PIECE}}}"
    return f"regexp_extract_all({line}, '{pattern}', 1)"


def _starts(piece: str) -> str:
    """The places of a piece, from 1, where its shingles begin: one if it is short."""
    return f"sequence(1, greatest(1, length({piece}) - {CHARACTERS - 1}))"


def _shingles(lines: DataFrame) -> DataFrame:
    """``h1, h2, s``: every shingle of every line, some of long words twice.

    A line is exploded by its bytes, and of these only the ones after a blank stay: all inside
    generated code, where each match of a regular expression would cost more than such a word. UTF-8 has
    no blank inside of a character, and ``CHARACTERS`` of them are 4 times as many bytes at most.
    """
    # In a struct that is exploded, a line's hashes are there once and not made again for each shingle.
    named = f"named_struct('h1', h1, 'h2', h2, 'line', {_single('line')})"
    spaced = lines.select(F.explode(F.expr(f"array({named})")).alias("of"))
    whole, pieces = "array(cast(of.line AS binary))", f"cast({_pieces('of.line')} AS array<binary>)"
    parts = f"if({_has_long('of.line')}, concat({whole}, {pieces}), {whole})"
    parted = spaced.select("of", F.posexplode(F.expr(parts)).alias("k", "part"))
    places = f"if(k = 0, octet_length(part), greatest(1, length(cast(part AS string)) - {CHARACTERS - 1}))"
    placed = parted.select("of", "k", "part", F.explode(F.expr(f"sequence(0, {places} - 1)")).alias("i"))
    placed = placed.where("k > 0 OR i = 0 OR substring(part, i, 1) = X'20'")
    begun = f"substring(cast(substring(part, i + 1, {4 * CHARACTERS}) AS string), 1, {CHARACTERS})"
    inner = f"substring(cast(part AS string), i + 1, {CHARACTERS})"
    cut = placed.select("of.h1", "of.h2", "k", F.expr(f"if(k = 0, {begun}, {inner})").alias("s"))
    # Of eight words of one character each, the blank that follows does not count.
    eight = f"k = 0 AND endswith(s, ' ') AND substring(s, 2, 1) = ' ' AND s RLIKE '^(?:[^ ] ){{{CHARACTERS // 2}}}$'"
    return cut.select("h1", "h2", F.expr(f"if({eight}, substring(s, 1, {CHARACTERS - 1}), s)").alias("s"))


_HALVES = (("u", "shiftrightunsigned(g{0}, 32)"), ("v", "g{0} & 4294967295L"))


def _lists(lines: DataFrame) -> DataFrame:
    """``key, h1, centre``: lines that share a band's key with others, by ``h1``, and whether they are a centre of its list."""
    hashed = _shingles(lines).select("h1", "h2", F.expr("xxhash64(s)").alias("h"))
    # A hash of a hash takes one round; one of a hash and a number takes two.
    mixed = hashed.withColumn("g0", F.expr("xxhash64(h)"))
    for band in range(1, BANDS):
        mixed = mixed.withColumn(f"g{band}", F.expr(f"xxhash64(g{band - 1})"))
    halves = [(f"{part}{band}", text.format(band)) for band in range(BANDS) for part, text in _HALVES]
    signed = mixed.groupBy("h1", "h2").agg(*[F.min(F.expr(text)).alias(name) for name, text in halves])
    keys = [f"xxhash64({band}, u{band}, v{band})" for band in range(BANDS)]
    # One shuffle for the sizes and the join on them. Most values are of one line: their lists go without being sorted.
    posted = signed.select("h1", F.explode(F.expr(f"array({', '.join(keys)})")).alias("key")).repartition("key")
    # Both sides read ``h1``, or they would not be the same shuffle.
    sizes = posted.groupBy("key").agg(F.count("*").alias("size"), F.min("h1").alias("low"), F.max("h1").alias("high"))
    sizes = sizes.where("low < high").select("key", "size")
    sized = stored(posted.join(sizes.hint("shuffle_hash"), "key"), "line-sizes")
    # A line in the middle of many others shares most of its lists with them: it weighs most.
    weights = sized.groupBy("h1").agg(F.sum("size").alias("weight"))
    shares = f"least(size - 1, greatest({CENTRES}, int(sqrt(size)) div {CENTRES}))"
    shared = sized.join(weights, "h1").withColumn("share", F.expr(f"pmod(h1, {shares})"))
    centres = shared.groupBy("key", "share").agg(F.max_by("h1", F.struct("weight", "h1")).alias("h1"))
    marked = sized.join(centres.select("key", "h1", F.lit(True).alias("centre")), ["key", "h1"], "left")
    lists = stored(marked.select("key", "h1", F.expr("centre IS NOT NULL").alias("centre")), "line-lists")
    drop_stored(sized)
    return lists


def _perhaps(lines: DataFrame, lists: DataFrame) -> DataFrame:
    """The lines that may be in a list: most that are in none are left out before any shuffle.

    The filter has a bit for each ``h1`` of a list, so lines of other lists may stay; it has ``FILTER_WORDS`` longs
    at most, however many lines there are.
    """
    word, bit = f"pmod(h1, {FILTER_WORDS})", "shiftleft(1L, int(shiftrightunsigned(h1, 58)))"
    bits = lists.select(F.expr(word).alias("word"), F.expr(bit).alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # A semi-join: Spark would move the exact one below an inner join, and shuffle every line after all.
    return lines.join(F.broadcast(bits), F.expr(f"{word} = word AND bits & {bit} <> 0"), "left_semi")


def _candidates(lists: DataFrame) -> DataFrame:
    """Edges ``a, b`` (by ``h1``) of each line and the centres of its lists."""
    centres = lists.where("centre").select("key", F.col("h1").alias("at"))
    pairs = lists.join(centres, "key").where("h1 <> at")
    return pairs.select(F.greatest("h1", "at").alias("a"), F.least("h1", "at").alias("b")).distinct()


def _links(lines: DataFrame, lists: DataFrame) -> DataFrame:
    """Edges ``a, b`` between names of lines of a list whose sets are similar enough."""
    listed = lists.select("h1").distinct().hint("shuffle_hash")
    inside = _perhaps(lines, lists).select("h1", "h2", "line").join(listed, "h1", "left_semi").distinct()
    spaced = inside.select("h1", F.expr(NAME).alias("id"), F.expr(_single("line")).alias("line"))
    inner = f"transform({_starts('p')}, i -> xxhash64(substring(p, i, {CHARACTERS})))"
    hashes = f"p -> if(length(p) <= {CHARACTERS}, array(xxhash64(p)), {inner})"
    own = f"array_distinct(flatten(transform({_parts('line')}, {hashes})))"
    sets = spaced.select("h1", "id", F.expr(own).alias("own")).withColumn("n", F.size("own"))
    sets = stored(sets, "line-sets")
    # Every line against the centres of each of its lists.
    edges = _candidates(lists).withColumnsRenamed({"a": "h1", "b": "least"}).join(sets, "h1")
    spokes = stored(_similar(edges, sets.withColumnRenamed("h1", "least"), ["least"], "TRUE"), "line-spokes")
    parts = components(spokes, "line-parts").withColumnsRenamed({"component": "part"})
    # Then the other lines of a list: those outside its largest part against all of them, in blocks.
    dealt = sets.select("h1", "id", "n").join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    dealt = stored(lists.where("NOT centre").join(dealt, "h1").select("key", "id", "n", "part"), "line-dealt")
    drop_stored(parts)
    drop_stored(lists)
    sizes = dealt.groupBy("key", "part").agg(F.sum("n").alias("w"))
    main = F.max_by("part", F.struct("w", "part")).alias("main")
    sizes = sizes.groupBy("key").agg(main, F.max("w").alias("w"), F.sum("w").alias("weight"))
    sizes = sizes.withColumn("rest", F.expr("weight - w")).where("rest > 0")
    blocks = f"greatest(1, int(({{0}} + {BLOCK_SHINGLES - 1}) div {BLOCK_SHINGLES}))"
    sizes = sizes.select("key", "main", F.expr(blocks.format("rest")).alias("rows"), F.expr(blocks.format("weight")).alias("columns"))
    rest = dealt.join(sizes, "key").join(sets.select("id", "own"), "id")
    rest = stored(rest.withColumn("main", F.expr("part = main")), "line-rest")
    drop_stored(dealt)
    drop_stored(sets)
    left = rest.where("NOT main").select("*", F.expr("int(pmod(xxhash64(id), rows))").alias("i"))
    left = left.select("*", F.explode(F.expr("sequence(0, columns - 1)")).alias("j"))
    right = rest.select("*", F.expr("int(pmod(xxhash64(id), columns))").alias("j"))
    right = right.select("*", F.explode(F.expr("sequence(0, rows - 1)")).alias("i"))
    # A pair outside the largest part is met from both sides: once is enough.
    across = _similar(left, right, ["key", "i", "j"], "part_a <> part_b AND (main_b OR a < b)")
    return spokes.union(across)


def _similar(left: DataFrame, right: DataFrame, keys: list[str], which: str) -> DataFrame:
    """Edges ``a, b`` of rows with equal ``keys`` and similar sets; ``which`` is tested first."""
    sides = [
        side.select(*keys, *(F.col(c).alias(e if c == "id" else f"{c}_{e}") for c in ("id", "own", "n", *more)))
        for side, e, more in (
            (left, "a", [c for c in ("part",) if c in left.columns]),
            (right, "b", [c for c in ("part", "main") if c in right.columns]),
        )
    ]
    # 100 s >= P (a + b - s) with the s shared of a and b shingles.
    similar = (
        f"{which} AND 100L * least(n_a, n_b) >= {PERCENT}L * greatest(n_a, n_b) "
        f"AND {100 + PERCENT}L * size(array_intersect(own_a, own_b)) >= {PERCENT}L * (n_a + n_b)"
    )
    other = sides[1].withColumnsRenamed({key: f"{key}_" for key in keys})
    same = " AND ".join(f"{key} = {key}_" for key in keys)
    return sides[0].join(other, F.expr(f"{same} AND {similar}")).select("a", "b")


# The name of a line as one orderable value.
NAME = "concat(lpad(hex(h1), 16, '0'), lpad(hex(h2), 16, '0'))"


def line_classes(lines: DataFrame, numbered: DataFrame) -> DataFrame:
    """``h1, h2, component, first_doc`` of every line that occurs twice, in the same or similar words.

    ``lines`` are those of ``_lines``, ``numbered`` the same without their text.
    """
    links = _links(lines, _lists(lines))
    similar = components(links, "line-classes")
    drop_stored(links)
    counted = numbered.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    named = counted.withColumn("id", F.expr(NAME)).join(similar, "id", "left").where("n > 1 OR component IS NOT NULL")
    named = named.select("h1", "h2", "first_doc", F.coalesce("component", "id").alias("component"))
    named = stored(named, "line-names")
    firsts = named.groupBy("component").agg(F.min("first_doc").alias("first_doc"))
    return named.drop("first_doc").join(firsts, "component")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, removed`` for each row of ``docs``: the numbers, from 0, of its lines that go.

    A null text has no lines and an empty one has one, which is blank. Blank lines and rows without
    an id always stay. Of a component the first line of its least ``doc_id`` stays; rows
    that repeat one ``doc_id`` and text are one document, and each other text of the id is another.
    """
    return _removed(docs).drop("of")


def _removed(docs: DataFrame) -> DataFrame:
    """The rows of ``repeated_lines``, with the hash of their text as ``of``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = _lines(docs.where("doc_id IS NOT NULL"))
    numbered = stored(lines.select("doc_id", "of", "line_no", "h1", "h2"), "line-numbers")
    classes = stored(line_classes(lines, numbered), "line-components")
    repeated = numbered.join(classes, ["h1", "h2"])
    # Of the lines of a component in its first document, the least number stays.
    place = F.struct("line_no", "of")
    first = repeated.where("doc_id = first_doc").groupBy("component").agg(F.min(place).alias("first_place"))
    stays = "doc_id = first_doc AND line_no = first_place.line_no AND of = first_place.of"
    repeated = repeated.join(first, "component").where(f"NOT ({stays})")
    removed = repeated.groupBy("doc_id", "of").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    sizes = docs.select("doc_id", F.expr(TEXT).alias("of"), F.expr("coalesce(size(split(text, '\\n')), 0)").alias("n_lines"))
    result = sizes.join(removed, ["doc_id", "of"], "left")
    return result.select("doc_id", "of", "n_lines", F.expr("coalesce(removed, array())").cast("array<int>").alias("removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of ``repeated_lines`` left out of ``text``; rows and other columns stay as they are.

    A text that loses all of its lines becomes empty.
    """
    removed = _removed(docs).where("size(removed) > 0").select("doc_id", "of", "removed").distinct()
    removed = stored(removed, "removed-lines")
    # In a struct, no column of the documents can clash with those added here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.withColumn("of", F.expr(TEXT.replace("text", "cast(row.text AS string)")))
    joined = rows.join(removed, ["doc_id", "of"], "left")
    kept = "array_join(filter(split(row.text, '\\n'), (line, i) -> NOT array_contains(removed, i)), '\\n')"
    text = F.expr(f"CASE WHEN removed IS NULL THEN row.text ELSE {kept} END")
    return joined.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
