"""Line dedup: suffix array over line ids by distributed prefix doubling.

The corpus is one sequence of line ids, documents in order of (doc_id, text hash), a
unique end after each document. Suffixes are ranked by prefix doubling in the manner of
Larsson and Sadakane: a rank is the number of suffixes that sort before the group, a
round splits each group by the rank h lines further on, and a suffix that is alone in
its group leaves at once, since no run through it repeats. Rounds go on until all have left, so
that all repeated runs are followed to their ends. The groups of a round are the LCP intervals
of at least its depth: their suffixes share a run of so many lines, and a document that has a later
member holds a run that occurs before. The union of the runs that start at a later member of an
interval of depth `min_lines` is the union of all maximal repeated runs' later copies, and is
deleted; the deepest interval that a document has a later member in tells how long its runs are.

Copies of a whole text are settled by its hash: all lines of a later one that stand in a run go,
and the suffixes are those of distinct texts. A rank is found without bringing a group together:
counts are summed by (rank, next rank) and added up within ranges of the next rank, which hold about
as many suffixes each.

With `min_words`, a run of one line counts too if the line has that many words: the
intervals of depth 1, kept to long lines. With `across_blanks`, suffixes are numbered by
the lines that aren't blank, so that blank lines between don't break a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, key_columns, unused, with_key

#: Production parameter: a run of fewer lines is left alone.
MIN_LINES = 2
#: For min_words: a single line of so many words is a run. The query and the pipeline go without, by the SQL and the stage's test.
MIN_WORDS = 50
#: Ranges of ranks that sums are made in; a window over ranges has so many rows at most.
RANGES = 4096


def name_groups(rows: DataFrame, total: int, r: str, r2: str) -> DataFrame:
    """(r, r2, rank, first) of each pair that occurs more than once among rows (d, t, i, r, r2).

    rank: suffixes with a smaller r, plus those of equal r with a smaller r2; first: the first suffix
    with the pair. r2 lies in [0, total); r is the number of suffixes with a smaller r.
    """
    shift = max(0, total.bit_length() - RANGES.bit_length() + 1)
    groups = durable(rows.groupBy(r, r2).agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "i")).alias("first")).withColumn("range", F.shiftright(r2, shift)))
    before = Window.partitionBy(r).orderBy("range")
    ranges = groups.groupBy(r, "range").agg(F.sum("n").alias("s")).select(r, "range", (F.sum("s").over(before) - F.col("s")).alias("before"))
    inside = Window.partitionBy(r, "range").orderBy(r2)
    some = groups.withColumn("inside", F.sum("n").over(inside) - F.col("n")).where("n > 1")
    return some.join(ranges, [r, "range"]).select(r, r2, (F.col(r) + F.col("before") + F.col("inside")).alias("rank"), "first")


def first_ranks(lines: DataFrame) -> DataFrame:
    """(h, rank, first) for each line hash that occurs more than once; rank: repeated lines with a smaller hash.

    The prefix sum goes over 65,536 ranges of the hash first and then within each.
    """
    counts = durable(lines.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "i")).alias("first")).where("n > 1").withColumn("range", F.shiftright("h", 48)))
    sums = counts.groupBy("range").agg(F.sum("n").alias("s"))
    ranges = sums.select("range", (F.sum("s").over(Window.orderBy("range")) - F.col("s")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("h")) - F.col("n")
    some = counts.withColumn("inside", inside)
    return some.join(F.broadcast(ranges), "range").select("h", (F.col("before") + F.col("inside")).alias("rank"), "first")  # 65,536 rows at most


def suffixes(named: DataFrame, *extra: str) -> DataFrame:
    """(d, t, i, r, later): later is false for the first suffix of its group."""
    return named.select("d", "t", "i", F.col("rank").alias("r"), (F.struct("d", "t", "i") != F.col("first")).alias("later"), *extra)


def intervals(lines: DataFrame, min_lines: int):
    """Yields (depth, suffixes in groups of this depth) from 1 on, through min_lines, until no two suffixes share a group.

    A suffix whose document ends before that, or whose continuation is already alone,
    shares no run of this depth and leaves.
    """
    extra = ["long"] if "long" in lines.columns else []
    active, depth = durable(suffixes(lines.join(first_ranks(lines), "h"), *extra)), 1
    while n := active.count():
        yield depth, active
        step = min(depth, min_lines - depth) if depth < min_lines else depth
        onward = F.first("r").over(Window.partitionBy("d", "t").orderBy("i").rangeBetween(step, step))
        pairs = durable(active.select("d", "t", "i", "r", onward.alias("r2")).where("r2 is not null"))
        total = pairs.agg(F.max(F.greatest("r", "r2"))).first()[0]
        if total is None:
            return
        active = durable(suffixes(pairs.join(name_groups(pairs, total + 1, "r", "r2"), ["r", "r2"])))
        depth += step


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None, across_blanks: bool = False) -> DataFrame:
    """(d, t, runs, depth) of every distinct text at its first document, or of every document with min_words.

    runs: in order, the first and last index of runs of lines to delete, among all lines or, across
    blanks, among those that aren't blank; null for none. depth: that of the deepest interval of
    min_lines or more in which the text has a later member; null for none.
    """
    texts = docs.where("text is not null").select(*key_columns(), F.split("text", "\n", -1).alias("a"))
    long = lambda x: (F.length(x) >= 2 * (min_words or 0) - 1) & (F.size(F.array_remove(F.split(x, r"\s+"), "")) >= min_words)
    value = lambda x: F.struct(F.xxhash64(F.rtrim(x)).alias("h"), *([long(x).alias("long")] if min_words else []))
    hashed = F.transform("a", lambda x: F.when(F.trim(x) != "", value(x)))
    if across_blanks:
        hashed = F.filter(hashed, lambda x: x.isNotNull())
    kept = texts.select("d", "t", hashed.alias("a"))
    kept = kept.groupBy("d", "t").agg(F.first("a").alias("a")) if min_words else kept.groupBy("t").agg(F.min("d").alias("d"), F.first("a").alias("a"))
    kept = durable(kept)
    lines = kept.select("d", "t", F.posexplode("a").alias("i", "x")).where("x is not null").select("d", "t", "i", "x.*")
    cover, depths = None, None
    for depth, active in intervals(lines, min_lines):
        at = active.where("later")
        found = at.select("d", "t", "i") if depth == min_lines else at.where("long").select("d", "t", "i") if depth == 1 and min_words else None
        if found is not None and depth == min_lines:
            found = found.select("d", "t", F.explode(F.sequence(F.col("i"), F.col("i") + min_lines - 1)).alias("i"))
        if found is not None:
            cover = found if cover is None else cover.unionByName(found)
        if depth >= min_lines:
            deep = at.groupBy("d", "t").agg(F.lit(depth).alias("depth"))
            depths = deep if depths is None else depths.unionByName(deep)
    keys = kept.select("d", "t")
    if cover is None:
        return keys.select("d", "t", F.expr("cast(null as array<struct<a:int,z:int>>)").alias("runs"), F.expr("cast(null as int)").alias("depth"))
    islands = cover.distinct().withColumn("g", F.col("i") - F.row_number().over(Window.partitionBy("d", "t").orderBy("i")))
    spans = islands.groupBy("d", "t", "g").agg(F.min("i").alias("a"), F.max("i").alias("z"))
    runs = spans.groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("a", "z"))).alias("runs"))
    out = keys.join(runs, ["d", "t"], "left")
    if depths is None:
        return out.withColumn("depth", F.expr("cast(null as int)"))
    return out.join(depths.groupBy("d", "t").agg(F.max("depth").alias("depth")), ["d", "t"], "left")


def _whole(lines: str, min_lines: int, across_blanks: bool) -> tuple[str, str]:
    """SQL for (runs, depth) of a later copy of a whole text: all runs of min_lines or more lines that aren't blank."""
    if across_blanks:
        size = f"size(filter({lines}, x -> trim(x) != ''))"
        runs, longest = f"if({size} >= {min_lines}, array(struct(0 as a, {size} - 1 as z)), null)", size
    else:
        edge = lambda at, by: f"filter(transform({lines}, (x, i) -> if(trim(x) != '' and coalesce(trim(get({lines}, i {by} 1)), '') = '', i, null)), i -> i is not null)"
        zipped = f"zip_with({edge('a', '-')}, {edge('z', '+')}, (a, z) -> struct(a, z))"
        runs, longest = f"filter({zipped}, r -> r.z - r.a + 1 >= {min_lines})", f"array_max(transform({zipped}, r -> r.z - r.a + 1))"
    return runs, f"if({longest} >= {min_lines}, cast({min_lines} * shiftleft(1, length(bin({longest} div {min_lines})) - 1) as int), null)"


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, report: bool = False, min_words: int | None = None, across_blanks: bool = False) -> DataFrame:
    """Documents without the later copies of runs of `min_lines` or more equal lines.

    Lines are equal without trailing blanks; blank lines match nothing and stay. The
    first copy, by (doc_id, text hash, line), stays. With min_words, a single line of at least that
    many words is a run as well. With across_blanks, lines with only blank lines between are
    neighbours, and blank lines between two lines that go, go with them. All columns are kept; n_chars, if
    there, follows the text. A document of which every line goes keeps an empty text.
    Null texts stay null. Null ids count as one id before all others. Rows equal in id
    and text are one document and all get its result. An empty table gives an empty
    one. Extra columns pass through under any name.
    With report=True: doc_id, text, n_lines (0 for null), n_removed, run_depth: min_lines times the largest
    power of two for which a run of so many lines of the document occurs before; 0 for none.
    """
    keyed, names = with_key(docs)
    runs, depth = unused(keyed.columns, "__runs"), unused(keyed.columns, "__depth")
    found = later_copies(docs, min_lines, min_words, across_blanks).withColumn("there", F.lit(True))
    there = unused(keyed.columns, "__there")
    full = keyed.join(found.select("d", "t", "there", "runs", "depth").toDF(*names, there, runs, depth), names, "left")
    lines = unused(keyed.columns, "__lines")
    full = full.withColumn(lines, F.split("text", "\n", -1))
    of_copy, depth_of_copy = _whole(lines, min_lines, across_blanks)
    copy = F.col(there).isNull() & F.col("text").isNotNull()
    full = full.withColumns({runs: F.when(copy, F.expr(of_copy)).otherwise(F.col(runs)), depth: F.when(copy, F.expr(depth_of_copy)).otherwise(F.col(depth))})
    if across_blanks:
        solid = f"filter(transform({lines}, (x, i) -> if(trim(x) != '', i, null)), i -> i is not null)"
        full = full.withColumn(runs, F.when(F.size(runs) > 0, F.expr(f"transform(array({solid}), s -> transform({runs}, r -> struct(s[r.a] as a, s[r.z] as z)))[0]")))
    some = F.coalesce(F.size(runs), F.lit(0)) > 0
    rest = F.expr(f"array_join(filter({lines}, (x, i) -> not exists({runs}, r -> i between r.a and r.z)), '\n')")
    text = F.when(some, rest).otherwise(F.col("text"))
    if report:
        gone = F.coalesce(F.expr(f"aggregate({runs}, 0, (s, r) -> s + r.z - r.a + 1)"), F.lit(0))
        return full.select("doc_id", text.alias("text"), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), gone.alias("n_removed"), F.coalesce(F.col(depth), F.lit(0)).alias("run_depth"))
    out = unused(full.columns, "__text")
    full = full.withColumn(out, text)
    own = {"text": F.col(out), "n_chars": F.when(some, F.length(out).cast("bigint")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return full.select(*[own[c].alias(c) if own.get(c) is not None else F.col(f"`{c}`") for c in docs.columns])


def _sql(deepest: int = 14) -> str:
    """Brute force in SQL: every window of 2, 4, 8, ... lines, grouped by its text; those of 2 are deleted."""
    level = "l1 as (select doc_id, i, case when trim(line, ' ') <> '' then rtrim(line, ' ') end as v from l)"
    for k in range(1, deepest + 1):
        level += f",\nl{2**k} as (select a.doc_id, a.i, md5(a.v) || md5(b.v) as v from l{2 ** (k - 1)} a join l{2 ** (k - 1)} b on b.doc_id = a.doc_id and b.i = a.i + {2 ** (k - 1)} where a.v is not null and b.v is not null)"
    late = " union all ".join(f"select doc_id, i, {2**k} as n, row_number() over (partition by v order by doc_id, i) as k from l{2**k}" for k in range(1, deepest + 1))
    return rf"""
with l as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
{level},
f as (select doc_id, i, n from ({late}) where k > 1),
g as (select distinct doc_id, i + s as i from f, (select unnest([0, 1]) as s) where n = 2),
r as (select l.doc_id, l.i, l.line, g.i is not null as gone from l left join g on l.doc_id = g.doc_id and l.i = g.i),
t as (select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as text, cast(count(*) as int) as n_lines, cast(count(*) filter (gone) as int) as n_removed from r group by doc_id)
select t.*, coalesce(n, 0) as run_depth from t left join (select doc_id, cast(max(n) as int) as n from f group by doc_id) using (doc_id)
"""


SQL = _sql()
