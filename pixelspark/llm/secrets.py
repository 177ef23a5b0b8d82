"""Multipart credential linking, in built-in functions only.

Strong parts (assignments, access identifiers, hexadecimal runs) are always reported. Weak ones (bare keys, short
assigned values, endpoints) say nothing alone: they are reported where an interval join finds their complement within
a scope of ``SCOPE`` code points around an access identifier. A weak secret needs the identifier; an endpoint needs
the identifier and a secret, weak or strong, in the same scope.

Places come from splitting a text at the matches: a match starts behind the pieces and matches before it. Lengths are in
code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import stored, text_or_empty

SCOPE = 200
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is too short is consumed whole, so asking for the length in the pattern finds the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Of any length, padded or not; it may follow an equals sign or a quote, as in name=key.
KEY = r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{32,}+={0,2}(?![A-Za-z0-9/+=])"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""
#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "key", "short", "endpoint")
SPAN = "struct<s:int,k:int,e:int>"
LEAST_VALUE, LEAST_WEAK_VALUE = 12, 6


#: Matches whose places are added up together, and code points of a text that are masked together.
FOLD, BLOCK = 64, 4096


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def _found(df: DataFrame, out: str, pattern: str, kind: str, when: Column | None = None, value: str = "0") -> DataFrame:
    """Adds ``out``: spans (s, k, e, v) of the pattern in ``body``; v is ``value``, an expression on the match x.got and its group 2, x.val.

    A place is the sum of the lengths before it. They are summed by blocks of FOLD matches, and in a block match by match, so
    no array is copied once for each match of the text. Arrays are walked, never indexed.
    """
    k = KINDS.index(kind)
    hit = F.col("body").rlike(pattern) if when is None else when & F.col("body").rlike(pattern)
    got = [F.split("body", pattern, -1).alias("cut"), F.regexp_extract_all("body", _lit(pattern), F.lit(0)).alias("got")]
    if "x.val" in value:
        got.append(F.regexp_extract_all("body", _lit(pattern), F.lit(2)).alias("val"))
    zipped = F.arrays_zip(*got)
    step = f"concat(t.a, array(named_struct('s', t.p + x.gap, 'k', {k}, 'e', t.p + x.gap + x.own, 'v', x.v)))"
    empty = "cast(array() as array<struct<s:int,k:int,e:int,v:int>>)"
    return (df.withColumn("_zip", F.when(hit, zipped))
            .withColumn("_len", F.expr(f"transform(filter(_zip, x -> x.got is not null), x -> named_struct('gap', length(x.cut), 'own', length(x.got), 'v', cast({value} as int)))"))
            .withColumn("_part", F.expr(f"if(size(_len) > 0, transform(sequence(0, (size(_len) - 1) div {FOLD}), i -> slice(_len, int(i) * {FOLD} + 1, {FOLD})), null)"))
            .withColumn("_from", F.expr("""aggregate(_part, named_struct('p', 0, 'a', cast(array() as array<int>)),
                (t, b) -> named_struct('p', t.p + aggregate(b, 0, (n, x) -> n + x.gap + x.own), 'a', concat(t.a, array(t.p))), t -> t.a)"""))
            .withColumn(out, F.coalesce(F.expr(f"""flatten(transform(arrays_zip(_part, _from), z -> aggregate(z._part, named_struct('p', z._from, 'a', {empty}),
                (t, x) -> named_struct('p', t.p + x.gap + x.own, 'a', {step}), t -> t.a)))"""), F.expr(empty)))
            .drop("_zip", "_len", "_part", "_from"))


def with_key(docs: DataFrame) -> DataFrame:
    """Adds ``body`` and a key of the row's content; rows with the same id and text have the same key and spans."""
    return (docs.withColumn("body", text_or_empty())
            .withColumn("_k1", F.xxhash64(F.lit(1), "doc_id", "body")).withColumn("_k2", F.xxhash64(F.lit(2), "doc_id", "body")))


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, keys, ``strong`` and ``weak`` spans of every row. The patterns for weak parts run where an identifier is.

    Weak keys are not yet held against strong spans.
    """
    df = with_key(docs.select("doc_id", "text"))
    df = _found(df, "assign", ASSIGN, "assign", value="length(x.val)")
    df = _found(df, "access", ACCESS, "access")
    df = _found(df, "hex", HEX, "hex")
    near = F.size("access") > 0
    df = _found(df, "key", KEY, "key", near, "x.got rlike '[0-9]' and x.got rlike '[a-z]' and x.got rlike '[A-Z]'")
    df = _found(df, "endpoint", ENDPOINT, "endpoint", near)
    plain = lambda column, where, k: F.expr(
        f"transform(filter({column}, x -> {where}), x -> named_struct('s', x.s, 'k', {KINDS.index(k)}, 'e', x.e))").cast(f"array<{SPAN}>")
    short = F.when(near, plain("assign", f"x.v < {LEAST_VALUE} and x.v >= {LEAST_WEAK_VALUE}", "short")).otherwise(F.array().cast(f"array<{SPAN}>"))
    strong = F.concat(plain("assign", f"x.v >= {LEAST_VALUE}", "assign"), plain("access", "true", "access"), plain("hex", "true", "hex"))
    weak = F.concat(plain("key", "x.v = 1", "key"), short, plain("endpoint", "true", "endpoint"))
    return df.select("doc_id", "_k1", "_k2", F.sort_array(strong).alias("strong"), weak.alias("weak"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Interval join: the weak spans of each key that have their complement, as ``more``.

    A weak key that overlaps a strong span is none: seen in order of the starts, no strong span before it ends behind its
    start, and none behind it starts before its end.
    """
    name = {k: i for i, k in enumerate(KINDS)}
    key = ["_k1", "_k2"]
    both = (found.where(F.size("weak") > 0).where(F.expr(f"exists(strong, x -> x.k = {name['access']})"))
            .select(*key, "strong", "weak").dropDuplicates(key))
    cell = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    spans = both.select(*key, F.explode(F.concat("strong", "weak")).alias("x")).select(*key, "x.*")
    strong = F.col("k") < name["key"]
    before = Window.partitionBy(*key).orderBy("s", "k").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*key).orderBy(F.desc("s"), F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    meets = (F.coalesce(F.max(F.when(strong, F.col("e"))).over(before), F.lit(0)) > F.col("s")) | (
        F.coalesce(F.min(F.when(strong, F.col("s"))).over(behind), F.col("e")) < F.col("e"))
    spans = spans.withColumn("meets", meets).where((F.col("k") != name["key"]) | ~F.col("meets")).drop("meets")
    ids = (spans.where(F.col("k") == name["access"])
           .select(*key, F.col("s").alias("a_s"), F.col("e").alias("a_e"))
           .withColumn("cell", cell(F.col("a_s") - scope, F.col("a_e") + scope)))
    others = spans.where(~F.col("k").isin(name["access"], name["hex"])).withColumn("cell", cell(F.col("s"), F.col("e") - 1))
    pairs = (ids.join(others, [*key, "cell"])
             .where((F.col("s") <= F.col("a_e") + scope) & (F.col("e") >= F.col("a_s") - scope)))
    secret = F.col("k") != name["endpoint"]
    scopes = pairs.groupBy(*key, "a_s").agg(F.max(secret).alias("has_secret"), F.collect_set(F.struct("s", "k", "e")).alias("near"))
    reported = (scopes.select(*key, "has_secret", F.explode("near").alias("x"))
                .where((F.col("x.k") >= name["key"]) & ((F.col("x.k") != name["endpoint"]) | F.col("has_secret"))))
    return reported.groupBy(*key).agg(F.collect_set(F.col("x").cast(SPAN)).alias("more"))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, _k1, _k2, ``strong`` (base spans) and ``all`` (with the linked ones), ordered by start and kind.

    One row per row; null text counts as empty and has none; other columns are not read.
    """
    found = stored(parts(docs), "parts")
    none = F.array().cast(f"array<{SPAN}>")
    return (found.drop("weak").join(linked(found), ["_k1", "_k2"], "left")
            .withColumn("all", F.sort_array(F.concat("strong", F.coalesce("more", none)))).drop("more"))


def written(column: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", names[x["k"]], x["s"], x["e"])), ",")


def cuts(found: DataFrame) -> DataFrame:
    """For each key a map from block of BLOCK code points to what goes there: (from, to, whether the mask stands here).

    Overlapping spans are one; a span that crosses blocks has its mask in the first.
    """
    key = ["_k1", "_k2"]
    one = found.where(F.size("all") > 0).select(*key, "all").dropDuplicates(key)
    spans = one.select(*key, F.explode("all").alias("x")).select(*key, "x.s", "x.e")
    so_far = Window.partitionBy(*key).orderBy("s", "e")
    reach = F.coalesce(F.max("e").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grouped = spans.withColumn("new", (F.col("s") >= reach).cast("int")).withColumn("n", F.sum("new").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    merged = grouped.groupBy(*key, "n").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    first, last = F.floor(F.col("s") / BLOCK), F.floor((F.col("e") - 1) / BLOCK)
    cell = merged.select(*key, "s", "e", F.explode(F.sequence(first, last).cast("array<int>")).alias("i"))
    local = F.struct(F.greatest(F.col("s") - F.col("i") * BLOCK, F.lit(0)).alias("s"), F.least(F.col("e") - F.col("i") * BLOCK, F.lit(BLOCK)).alias("e"),
                     (F.floor(F.col("s") / BLOCK) == F.col("i")).alias("here"))
    blocks = cell.groupBy(*key, "i").agg(F.sort_array(F.collect_list(local)).alias("c"))
    return blocks.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("i", "c"))).alias("cuts"))


def masked(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced; n_chars, where it exists, follows the text. Null text stays null.

    Overlapping spans become one mask. Rows and columns stay as they are. Texts are rewritten block by block, so the work
    grows with a text's length and its spans.
    """
    keyed = with_key(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"))
    piece = f"""aggregate(coalesce(cuts[int(i)], cast(array() as array<struct<s:int,e:int,here:boolean>>)), named_struct('at', 0, 'out', cast(array() as array<string>)),
        (t, x) -> named_struct('at', int(x.e), 'out', concat(t.out, array(substr(b, t.at + 1, x.s - t.at), if(x.here, '{mask}', '')))),
        t -> concat(array_join(t.out, ''), substr(b, t.at + 1)))"""
    cut = F.expr(f"array_join(transform(regexp_extract_all(body, '(?s).{{1,{BLOCK}}}', 0), (b, i) -> {piece}), '')")
    new = keyed.join(cuts(spans(docs)), ["_k1", "_k2"], "left").withColumn("_new", F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(cut))
    cols = []
    for c in docs.columns:
        own = F.col("row")[c]
        if c == "text":
            own = F.col("_new")
        elif c == "n_chars":
            own = F.when(F.col("cuts").isNull(), own).otherwise(F.length("_new").cast(docs.schema[c].dataType))
        cols.append(own.alias(c))
    return new.select(*cols)
