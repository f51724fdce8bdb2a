"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Every word that is a number, a unit or a name inside a sentence becomes a typed placeholder. Windows of template
words are hashed and joined with the windows of the benchmark items, so a question whose numbers or names were
changed still meets its item. Documents that meet enough windows of an item are then judged by occurrence: in each,
every slot must have one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import WORD, matching, table, written

#: Words of a window, literal words it must have, windows that prove a leak, and the share of an item's windows that does for short items.
WINDOW, LITERALS, ENOUGH, PART = 8, 4, 6, 0.5
#: Words that a copy's words may be out of step by to count as one occurrence, whichever way they fall.
NEAR = 8
#: Most benchmark windows that are broadcast (some hundred bytes each); a larger benchmark is joined by an ordinary shuffle.
MAX_BROADCAST = 200_000
#: Placeholders start with a character that no word of a text keeps.
MARK = "\u0001"
_UNITS = "km m cm mm kg g mg lb oz l ml s ms min h hr hour hours minute minutes second seconds day days week weeks month months year years mile miles feet ft inches dollar dollars euro euros cent cents percent".split()
_TAIL = ")].,;:!?"
_NUMBER = r"^[(\[$€£+\-]{0,3}\d[\d.,:/]*(?:%|st|nd|rd|th|[km]?[gmls])?[)\].,;:!?]*$"
_NAME = r"^\p{Lu}[\p{L}'’\-]*[)\].,;:!?]*$"
_BEFORE_NAME = r"[\p{Ll}\p{N},;]$"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit("")), F.lit(WORD), F.lit(0))


def _lower(word: Column) -> Column:
    return F.transform(word, F.lower)


def _kinds(word: Column, low: Column) -> Column:
    """'n' number, 'u' unit, 'p' name (a capital inside a sentence) or '' for every word; cheap tests on a word's first character spare most words the patterns."""
    def kind(x: Column, i: Column) -> Column:
        small = F.get(low, i)
        unit = small.isin(_UNITS) | ((F.right(small, F.lit(1)) < "A") & F.rtrim(small, F.lit(_TAIL)).isin(_UNITS))
        number = ((x < ":") | (x >= "[")) & small.rlike(_NUMBER)
        name = (i > 0) & x.rlike(_NAME) & F.get(word, i - 1).rlike(_BEFORE_NAME)
        plain = (x >= "a") & (x < "{")
        return F.when(unit, "u").when(plain, "").when(number, "n").when(name, "p").otherwise("")
    return F.transform(word, kind)


def _template(low: Column, kind: Column, names: bool = True) -> Column:
    """The words with placeholders; letter case changes nothing without names."""
    return F.zip_with(low, kind, lambda x, k: F.when((k == "") | (F.lit(not names) & (k == "p")), x).otherwise(F.concat(F.lit(MARK), k)))


def _parts(rows: DataFrame, *keep: str) -> DataFrame:
    """raw (lower-cased words of `text`) and kind."""
    words = rows.select(*keep, _words(F.col("text")).alias("word"))
    return words.select(*keep, "word", _lower(F.col("word")).alias("raw")).select(*keep, "raw", _kinds(F.col("word"), F.col("raw")).alias("kind"))


def _forms(rows: DataFrame, *keep: str) -> DataFrame:
    """named, tpl and raw: the words of `text` with names as placeholders, without, and lower-cased as they stand."""
    return _parts(rows, *keep).select(*keep, *[_template(F.col("raw"), F.col("kind"), names).alias(to) for names, to in ((True, "named"), (False, "tpl"))], "raw")


def _hashed_forms(rows: DataFrame, *keep: str) -> DataFrame:
    """The same as hashes of the words."""
    slot = F.create_map(*[x for k in "nup" for x in (F.lit(k), F.xxhash64(F.lit(MARK + k)))])
    kept = lambda names: lambda h, k: F.when((k == "") | (F.lit(not names) & (k == "p")), h).otherwise(F.element_at(slot, k))
    hashed = _parts(rows, *keep).select(*keep, _hashed(F.col("raw")).alias("raw"), "kind")
    return hashed.select(*keep, *[F.zip_with("raw", "kind", kept(names)).alias(to) for names, to in ((True, "named"), (False, "tpl"))], "raw")


def _is_slot(word: Column) -> Column:
    return F.startswith(word, F.lit(MARK))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _window_hashes(rows: DataFrame, column: str, sizes: list[int]) -> DataFrame:
    """rows with `column` (a hash per word) replaced by the hashes of all its runs of each of the sizes, as column_size.

    Runs of 1, 2, 4, ... words are put together step by step, each step a projection of its own, so none is worked out
    twice. The early words of a long run enter with few bits: equal runs have equal hashes, which is all that counts here.
    """
    words, runs = F.size(column), {1: F.col(column)}
    rows = rows.withColumn(f"{column}_n", words)

    def joined(a: int, b: int) -> Column:
        many = F.greatest(F.lit(0), F.col(f"{column}_n") - (a + b - 1))
        return F.zip_with(F.slice(runs[a], F.lit(1), many), F.slice(runs[b], F.lit(a + 1), many), lambda x, y: F.shiftleft(x, 7 * b).bitwiseXOR(y))

    def made(rows: DataFrame, size: int) -> DataFrame:
        if size in runs:
            return rows
        most = 1 << (size.bit_length() - 1)
        a, b = (most, size - most) if size > most else (size // 2, size // 2)
        rows = made(made(rows, a), b)
        rows = rows.withColumn(f"{column}_{size}", joined(a, b))
        runs[size] = F.col(f"{column}_{size}")
        return rows

    for size in sizes:
        rows = made(rows, size)
    keep = [c for c in rows.columns if not c.startswith(column)]
    return rows.select(*keep, *[runs[size].alias(f"{column}_{size}") for size in sizes])


def _windows(named: Column, template: Column, raw: Column, sizes: list[int], bare: list[int], literals: int) -> Column:
    """pos, hash and the words themselves, with names as placeholders and, where that differs, without.

    Of the sizes in `bare` also those with fewer than `literals` literal words, as their plain words.
    """
    def of(size: int) -> Column:
        last = F.size(raw) - size + 1
        window = lambda form: lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(form, i, size)).alias("h"), F.slice(raw, i, size).alias("words"))
        names = F.filter(F.sequence(F.lit(1), F.size(raw)), lambda i: F.get(named, i - 1) == F.lit(MARK + "p"))
        around = F.array_distinct(F.flatten(F.transform(names, lambda i: F.sequence(F.greatest(F.lit(1), i - (size - 1)), F.least(i, last)))))
        poor = lambda i: F.size(F.filter(F.slice(template, i, size), lambda x: ~_is_slot(x))) < literals
        plain = [F.transform(F.filter(F.sequence(F.lit(1), last), poor), window(raw))] if size in bare else []
        every = F.concat(F.transform(F.sequence(F.lit(1), last), window(named)), F.transform(around, window(template)), *plain)
        return F.when(last >= 1, every).otherwise(F.array().cast("array<struct<pos:int,h:bigint,words:array<string>>>"))
    return F.concat(*[of(s) for s in sizes])


def item_windows(items: DataFrame, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """item_id, w, plain, h and g (hashes), ipos, islots (offset and item value), n_windows; an item shorter than a window is one window of its own length.

    A window with fewer than `literals` literal words, names being such, is plain: it has no slots and meets only its very words.
    """
    every = _forms(items, "item_id")
    forms = [every.select("item_id", F.lit(names).alias("names"), F.col(form).alias("tpl"), "raw") for names, form in ((True, "named"), (False, "tpl"))]
    both = forms[0].unionByName(forms[1]).filter(F.size("tpl") >= literals).withColumn("w", F.least(F.size("tpl"), F.lit(window)))
    spans = both.select("item_id", "names", "tpl", "raw", "w", F.explode(F.sequence(F.lit(1), F.size("tpl") - F.col("w") + 1)).alias("ipos"))
    part = F.slice("tpl", F.col("ipos"), F.col("w"))
    pair = F.zip_with(part, F.slice("raw", F.col("ipos"), F.col("w")), lambda t, x: F.struct(t.alias("t"), x.alias("x")))
    slots = F.filter(F.transform(pair, lambda p, k: F.struct(k.alias("k"), p["t"].alias("t"), p["x"].alias("i"))), lambda p: _is_slot(p["t"]))
    poor = F.size(F.filter(part, lambda x: ~_is_slot(x))) < literals
    known = spans.filter(~poor | ~F.col("names")).withColumn("plain", poor)
    shaped = known.select(
        "item_id", "w", "plain", F.when(F.col("plain"), F.slice("raw", F.col("ipos"), F.col("w"))).otherwise(part).alias("form"), "ipos",
        F.filter(slots, lambda p: ~F.col("plain")).alias("islots"), (F.size("tpl") - F.col("w") + 1).alias("n_windows"))
    sizes = list(range(1, window + 1))
    hashed = _window_hashes(shaped.withColumn("h", F.xxhash64("form")).withColumn("run", _hashed(F.col("form"))).drop("form"), "run", sizes)
    g = F.coalesce(*[F.when(F.col("w") == size, F.get(f"run_{size}", F.lit(0))) for size in sizes])
    return hashed.withColumn("g", g).drop(*[f"run_{size}" for size in sizes]).distinct()


def suspects(docs: DataFrame, known: DataFrame, sizes: list[int], bare: bool, enough: int, part: float) -> DataFrame:
    """doc_id of documents that hold, anywhere, as many windows of one item as a leak needs; known may be broadcast.

    All windows of all forms are looked up by hashes alone, without places and words, so few documents are left to judge.
    """
    hashes = _hashed_forms(docs, "doc_id").select("doc_id", "named", "tpl", *(["raw"] if bare else []))
    forms = hashes.columns[1:]
    for c in forms:
        hashes = _window_hashes(hashes, c, sizes)
    every = F.concat(*[F.col(f"{c}_{size}") for c in forms for size in sizes])
    hits = hashes.select("doc_id", F.explode(F.array_distinct(every)).alias("g")).join(known, "g")
    met = hits.groupBy("doc_id", "item_id").agg(F.size(F.collect_set("ipos")).alias("hit"), F.min("n_windows").alias("n_windows"))
    return met.filter(_proves(F.col("hit"), enough, part)).select("doc_id").distinct()


def _proves(hit: Column, enough: int, part: float) -> Column:
    return hit >= F.least(F.lit(enough), F.ceil(F.col("n_windows") * F.lit(part)))


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, literals: int = LITERALS, enough: int = ENOUGH, part: float = PART, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document and benchmark item that it leaks.

    doc_id, item_id, windows_hit, n_windows, slots (places of the item that held a number, unit or name), changed
    (those whose value differs), consistent (each place has one value), all of the occurrence with the most windows.
    An occurrence is the hits at one distance of document place and item place; for copies with words put in or
    left out also those at near distances, and all of a document, if they agree on every place's value. A leak has
    an occurrence with at least `enough` of the item's windows, or for short items the share `part` of them. Null
    texts have no windows, and rows without doc_id are left out. Items of fewer than `literals` words match nothing. Rows that repeat a doc_id count as
    one document. Either table empty: no rows. Other columns are ignored, whatever their names.
    """
    known = written(item_windows(items.select("item_id", "text"), window, literals))
    found = known.groupBy("w", "plain").agg(F.count("*").alias("n")).collect()  # at most 2 * `window` rows
    sizes, bare = sorted({r[0] for r in found}) or [window], [r[0] for r in found if r[1]]
    small = sum(r[2] for r in found) <= max_broadcast
    at_hand = F.broadcast if small else lambda x: x
    ids = written(suspects(docs.filter(F.col("doc_id").isNotNull()), at_hand(known.select("g", "item_id", "ipos", "n_windows").distinct()), sizes, bool(bare), enough, part))
    texts = _forms(matching(docs, ids, "doc_id", "left_semi"), "doc_id")
    rows = texts.select("doc_id", F.explode(_windows(F.col("named"), F.col("tpl"), F.col("raw"), sizes, bare, literals)).alias("x")).select("doc_id", "x.pos", "x.h", "x.words")
    hits = rows.join(at_hand(known.drop("g")), "h")
    # Equal templates have equal slots (up to a hash collision: then a place without a word).
    values = F.transform("islots", lambda p: F.struct((F.col("ipos") + p["k"]).alias("at"), p["i"].alias("i"), F.get("words", p["k"]).alias("d")))
    shift = F.col("pos") - F.col("ipos")
    near = lambda by: F.floor((shift + by) / F.lit(2 * NEAR)).cast("int")
    spots = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("spot")) for k, v in enumerate((shift, near(0), near(NEAR), F.lit(0)))])
    one = hits.select("doc_id", "item_id", "ipos", "n_windows", values.alias("values"), F.explode(spots).alias("o")).groupBy("doc_id", "item_id", "o").agg(
        F.collect_set("ipos").alias("at"), F.max("n_windows").alias("n_windows"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"))
    places = F.size(F.array_distinct(F.transform("values", lambda p: p["at"])))
    judged = one.select(
        "doc_id", "item_id", "o", F.size("at").alias("windows_hit"), "n_windows", F.size("values").alias("slots"),
        F.size(F.filter("values", lambda p: ~p["i"].eqNullSafe(p["d"]))).alias("changed"), (places == F.size("values")).alias("consistent"))
    # At one distance a place has one value, unless rows repeat a doc_id.
    found = judged.filter((F.col("consistent") | (F.col("o.kind") == 0)) & _proves(F.col("windows_hit"), enough, part))
    best = F.struct("windows_hit", (-F.col("changed")).alias("same"), "o", "n_windows", "slots", "changed", "consistent")
    return found.groupBy("doc_id", "item_id").agg(F.max(best).alias("b")).select("doc_id", "item_id", *[f"b.{c}" for c in ("windows_hit", "n_windows", "slots", "changed", "consistent")])


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs without the rows whose own text leaks an item; a null or repeated doc_id changes nothing."""
    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.xxhash64("text"))
    gone = written(leaks(docs.select(row.alias("doc_id"), "text"), items, **options).select("doc_id").distinct())
    return matching(docs.withColumn("_row", row), gone.withColumnRenamed("doc_id", "_row"), "_row", "left_anti", gone).select(*docs.columns)


def op7_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
