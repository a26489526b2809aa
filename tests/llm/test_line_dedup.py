"""Repeated lines against all pairs of whole sets."""

import random
import re
from itertools import combinations

import duckdb

from clearwell.llm import line_dedup as L
from clearwell.llm import sql
from tests.llm.cases import documents, edited, prose, root, texts, union


def lines_of(rows):
    for id_, text in rows:
        for number, line in enumerate(text.split("\n") if text is not None else ()):
            line = line.strip(" ").lower()
            if line:
                yield id_, number, line


def brute(rows):
    """(id, number) of the lines that go."""
    found = [(id_, number, line) for id_, number, line in lines_of(rows) if id_ is not None]
    own = {}
    for line in sorted({line for *_, line in found}):
        words = re.split(" +", line)
        own[line] = {" ".join(words[k : k + 8])[:16] for k in range(len(words))}
        own[line] |= {word[k : k + 16] for word in words for k in range(len(word) - 15)}
    parents = {line: line for line in own}
    for a, b in combinations(own, 2):
        if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
            union(parents, a, b)
    first, gone = {}, set()
    for id_, number, line in sorted(found):
        place = first.setdefault(root(parents, line), (id_, number))
        if place != (id_, number):
            gone.add((id_, number))
    return gone


def sample():
    line = prose(400, 60)
    rows = [*texts(), *((500 + k, edited(line, k, 50) + "\n" + prose(k, 9) + "\n\n" + line) for k in range(25))]
    text = line
    for k in range(30):  # a chain: the ends are not similar
        rows.append((600 + k, f"x{k}\n{text}"))
        text = edited(text, k, 60)
    return rows


def test_edge_rows(spark):
    # Rows that repeat an id with another text have no numbers of their own: left out of this comparison.
    rows = [r for r in sample() if r[0] not in (90, 91)]
    found = L.repeated_lines(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, number) for r in found for number in r.removed}
    want = brute(rows)
    assert got == want
    assert {r.doc_id: r.n_lines for r in found}[70] == 0 and {r.doc_id: r.n_lines for r in found}[71] == 1
    assert all(list(r.removed) == [] for r in found if r.doc_id is None)


def test_small_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_SHINGLES", 300)
    rows = [r for r in sample() if r[0] not in (90, 91)]
    found = L.repeated_lines(documents(spark, rows)).collect()
    assert {(r.doc_id, number) for r in found for number in r.removed} == brute(rows)


def test_texts_lose_these_lines_and_nothing_else(spark):
    rows = [r for r in sample() if r[0] not in (90, 91)]
    docs = documents(spark, rows)
    left = L.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    gone = brute(rows)
    want = {
        id_: None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (id_, k) not in gone)
        for id_, text in rows
        if id_ is not None
    }
    assert {r.doc_id: r.text for r in left.collect() if r.doc_id is not None} == want


def test_every_character_of_a_long_word_counts(spark):
    start, tail = "これは長い文の始まりでどれも同じです", "".join(chr(0x4E00 + k) for k in range(60))
    fields = "\t".join(f"field{k}" for k in range(40))
    long = "".join(chr(97 + k * k % 23 + k % 3) for k in range(200)) + "".join(map(str, range(900)))
    rows = [
        (1, "https://www.example.org/a/1"),
        (2, "https://www.example.org/b/other"),
        (3, start + tail[:30]),
        (4, start + tail[30:]),
        (5, "a common first field\twith one value of it"),
        (6, "a common first field\tand quite another"),
        (7, "id-0000000000001\tred\tsmall\tround"),
        (8, "id-0000000000001\tblue\tlarge\tsquare"),
        (9, long),  # Near copies: the beginning differs.
        (10, "x" + long),
        (11, "y" + long + " z"),
        (12, fields),
        (13, "F1\t" + fields),
        (14, "\U0001f600" * 17 + tail),
        (15, "!" + "\U0001f600" * 17 + tail),
    ]
    found = L.repeated_lines(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in found if r.removed) == [10, 11, 13, 15]


def test_pieces_have_all_shingles(spark):
    words = ["".join(chr(97 + k * 7 % 26) + str(k) for k in range(400))[:n] for n in (17, 64, 65, 79, 80, 81, 128, 143, 144, 999)]
    words = spark.createDataFrame([(w,) for w in words], "word string")
    pieces = words.selectExpr("word", f"explode({L._pieces('word')}) AS piece")
    found = pieces.selectExpr("word", f"explode(transform({L._starts('piece')}, i -> substring(piece, i, 16))) AS s")
    got = {}
    for r in found.collect():
        got.setdefault(r.word, []).append(r.s)
    assert got and all(sorted(s) == sorted(w[k : k + 16] for k in range(len(w) - 15)) for w, s in got.items())


def test_few_shingles_are_found_as_often_as_many(spark):
    # Pairs of 4 to 10 words of 16 characters, all but the last of the longer line shared: J = n / (n + 1).
    def word(seed):
        return "".join(random.Random(seed).choices("abcdefghijklmnopqrstuvwxyz", k=16))

    sizes, pairs = range(4, 11), 800
    rows = []
    for n in sizes:
        for k in range(pairs):
            words = [word(f"{n} {k} {at}") for at in range(n + 1)]
            id_ = 10_000 * n + 2 * k
            rows += [(id_, " ".join(words[:-1])), (id_ + 1, " ".join(words))]
    lines = L._lines(documents(spark, rows).select("doc_id", "text"))
    met = {r.id for r in L.components(L._candidates(L._lists(lines)), "small-sets").collect()}
    names = {r.doc_id: r.h1 for r in lines.collect()}
    for n in sizes:
        missed = sum(names[10_000 * n + 2 * k] not in met for k in range(pairs))
        similarity = n / (n + 1)
        claimed = pairs * (1 - similarity**2) ** L.BANDS
        assert missed <= claimed + 4 * max(1, claimed) ** 0.5, (n, missed, claimed)


def test_sql_has_the_sets_of_the_operator(spark):
    """Links, long words and scripts without blanks, where the words alone would link other lines."""
    start = "これは長い文の始まりでどれも同じです"
    texts_ = ["https://www.example.org/a/1", "https://www.example.org/b/other", start + "一" * 30, start + "二三" * 15]
    long = " ".join("".join(random.Random(k).choices("abcdef", k=40)) for k in range(12))
    texts_ += [long, "x " + long, long[:-1], prose(5, 30), prose(5, 30) + " end", "id\t" + "y" * 40 + "\n" + prose(5, 30)]
    rows = list(enumerate(texts_))
    docs = documents(spark, rows).select("doc_id", "text")
    got = L.repeated_lines(docs).collect()
    duck = duckdb.connect()
    duck.register("documents", docs.toPandas())
    want = duck.sql(sql.LINES).fetchall()
    shown = sorted((r.doc_id, r.n_lines, len(r.removed), ",".join(map(str, r.removed))) for r in got)
    assert shown == sorted(want) and sum(row[2] for row in want) == 3
    assert {(row[0], int(k)) for row in want if row[3] for k in row[3].split(",")} == brute(rows)


def test_texts_of_one_id_lose_their_own_lines_only(spark):
    a, b, c, d = (prose(k, 20) for k in range(700, 704))
    rows = [
        *[(1, a), (91, a), (91, b), (91, b + "\n" + a)],  # b stays in one of the texts of 91
        *[(92, c), (92, c), (92, d + "\n" + c)],  # equal rows are one document
        *[r for r in texts() if r[0] in (50, 90)], *((r[0] + 200, r[1]) for r in texts() if r[0] == 91),
    ]
    left = L.without_repeated_lines(documents(spark, rows)).collect()
    got = sorted((r.doc_id, r.text) for r in left)
    kept = [line for id_, text in set(got) for line in text.split("\n") if line]
    assert sorted(kept) == sorted({line for _, text in rows for line in text.split("\n")})
    assert [t for i, t in got if i == 92] == sorted([c, c, d])
    assert [t for i, t in got if i == 291] == ["", prose(30, 40)] and [t for i, t in got if i == 90] == ["", ""]
    assert (1, a) in got and len(got) == len(rows)


def test_empty_table(spark):
    assert L.repeated_lines(documents(spark, [])).collect() == []
    assert L.without_repeated_lines(documents(spark, [])).collect() == []


def test_main_path_has_no_python(spark):
    plan = L.without_repeated_lines(documents(spark, sample()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_one_scan_finds_the_shingles_of_words_one_by_one(spark):
    draw = random.Random(8)
    lines = [" " * draw.randint(0, 2) + draw.choice((" ", "  ")).join(
        "".join(draw.choices("abé一", k=draw.choice((1, 1, 1, 2, 5, 15, 16, 17, 90)))) for _ in range(draw.randint(1, 14))
    ) for _ in range(200)]
    lines += ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g hi", "x " + "a b c d e f g h " * 3]
    rows = spark.createDataFrame([(line.strip(" "),) for line in lines], "line string")
    spaced = rows.select("line", L.F.expr(L._single("line")).alias("spaced"))
    parts = spaced.select("line", L.F.explode(L.F.expr(L._parts("spaced"))).alias("p"))
    found = parts.selectExpr("line", f"explode(transform({L._starts('p')}, i -> substring(p, i, 16))) AS s")
    got = {}
    for r in found.collect():
        got.setdefault(r.line, set()).add(r.s)
    for line in lines:
        words = re.split(" +", line.strip(" "))
        want = {" ".join(words[k : k + 8])[:16] for k in range(len(words))}
        want |= {word[k : k + 16] for word in words for k in range(len(word) - 15)}
        assert got[line.strip(" ")] == want, line


def near_copies(count):
    """Distinct near copies of one line of 60 words, as documents: many similar to each other, many not."""
    words, rows = prose(41, 60).split(" "), []
    for k in range(count):
        draw, own = random.Random(k), list(words)
        own[draw.sample(range(len(own)), 1)[0]] = f"w{draw.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    return rows


def test_links_of_near_copies_do_not_grow_with_their_square(spark):
    rows = near_copies(240)
    docs = documents(spark, rows)
    lines = L._lines(docs.select("doc_id", "text"))
    assert L._links(lines, L._lists(lines)).count() < 30 * len(rows)
    found = L.repeated_lines(docs).collect()
    assert {(r.doc_id, number) for r in found for number in r.removed} == brute(rows)


def test_short_lists_need_no_second_step(spark):
    # A list of two or three lines has met its centres: nothing is left to compare.
    rows = near_copies(3)
    lines = L._lines(documents(spark, rows).select("doc_id", "text"))
    left = L._lists(lines).where("NOT centre").groupBy("key").count().collect()
    assert all(r["count"] == 1 for r in left)


def test_long_words_are_seen_wherever_they_stand(spark):
    lines = ["x" * 16, "x" * 17, "a " + "x" * 17, "x" * 17 + " a", "a b " + "x" * 16 + " c", "", "é" * 17, "ab cde " * 100_000]
    lines += [lines[-1] + "y" * 17]
    rows = spark.createDataFrame(list(enumerate(lines)), "k long, line string")
    found = {r.k: r.long for r in rows.selectExpr("k", f"{L._has_long('line')} AS long").collect()}
    assert [found[k] for k in range(len(lines))] == [max(map(len, line.split(" "))) > 16 for line in lines]


def test_lists_of_one_line_go_without_a_sort(spark, monkeypatch):
    plans = []

    def stored(df, label, own=L.stored):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return own(df, label)

    monkeypatch.setattr(L, "stored", stored)
    L._lists(L._lines(documents(spark, near_copies(3)).select("doc_id", "text")))
    plan = dict(plans)["line-sizes"]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and " Sort [" not in plan


def test_shingles_of_lines_cut_by_bytes_are_those_of_their_words(spark):
    draw, letters = random.Random(9), ("ab", "aé", "一b", "\U0001f600a\u2019", "Āа\t\r")
    lines = [
        draw.choice((" ", "  ")).join(
            "".join(draw.choices(draw.choice(letters), k=draw.choice((1, 1, 1, 2, 5, 15, 16, 17, 80, 200))))
            for _ in range(draw.randint(1, 14))
        )
        for _ in range(300)
    ]
    lines += ["é b c d e f g h", "é b c d e f g h i", "a b c d e f g 一 i", "a b c d e f g hi", "x " + "a b c d e f g h " * 3 + "y"]
    rows = L._lines(documents(spark, [(k, line) for k, line in enumerate(lines)]).select("doc_id", "text"))
    texts_ = {(r.h1, r.h2): r.line for r in rows.select("h1", "h2", "line").collect()}
    got = {}
    for r in L._shingles(rows).collect():
        got.setdefault(texts_[r.h1, r.h2], set()).add(r.s)
    assert set(got) == set(texts_.values()) and len(got) > 200
    for line, own in got.items():
        words = re.split(" +", line)
        want = {" ".join(words[k : k + 8])[:16] for k in range(len(words))}
        want |= {word[k : k + 16] for word in words for k in range(len(word) - 15)}
        assert own == want, line


def test_lists_and_their_sizes_are_one_shuffle(spark, monkeypatch):
    plans = []

    def stored(df, label, own=L.stored):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return own(df, label)

    monkeypatch.setattr(L, "stored", stored)
    L._lists(L._lines(documents(spark, near_copies(3)).select("doc_id", "text")))
    # Without h1 on one side, there would be two shuffles of every key.
    assert len(re.findall(r"\[h1#\d+L\], false, \[key#", dict(plans)["line-sizes"])) == 2


def test_lines_of_no_list_go_before_the_shuffle(spark):
    rows = near_copies(20) + [(100 + k, prose(5000 + k, 30)) for k in range(400)]
    lines = L._lines(documents(spark, rows).select("doc_id", "text"))
    lists = L._lists(lines)
    listed = {r.h1 for r in lists.select("h1").distinct().collect()}
    left = {r.h1 for r in L._perhaps(lines, lists).select("h1").collect()}
    assert len(listed) >= 20 and listed <= left and len(left) < len(listed) + 40
    found = L._perhaps(lines, lists).select("h1", "h2", "line")
    plan = found.join(lists.select("h1").distinct().hint("shuffle_hash"), "h1", "left_semi").distinct()
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ShuffledHashJoin") < plan.index("Exchange hashpartitioning(h1") < plan.index("BroadcastHashJoin")
