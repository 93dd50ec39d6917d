"""Registries that grow from document to document: symbols, manifest, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The letters a symbol is made of, what follows the first one, and words that are no symbols.
GREEK = "αβγδεζηθλμνρστφωΩΔ"
LETTERS = f"A-Za-z_{GREEK}ξ"
MARKS = "ˆ¯"
NO_SYMBOLS = ("and", "or", "the", "for", "are", "from", "where", "with")
# Units, the last of the parts of a description that commas divide.
UNITS = ("ft", "ft²", "ft2", "m", "m²", "m2", "mi/h", "m/s", "mph", "Hz", "dimensionless", "lb/ft", "lb/ft²", "lb/ft2", "N/m", "N/m²", "N/m2", "degrees", "%")
# Words of a formula that are no variables.
NO_VARIABLES = (
    "and", "or", "the", "in", "for", "ft", "mi", "lb", "SI", "where", "from", "mi/h", "m/s", "mph", "Hz", "sin", "cos", "tan", "ln", "log", "exp",
    "min", "max", "if", "of", "to", "at", "by", "is", "be", "as", "on",
)


def symbol_definitions(text: Column) -> Column:
    """array<struct<symbol, description, unit>> of ``SYM = description`` in a text.

    The text is divided at its equals signs.  What stands before a sign ends in a
    symbol; what stands after it is the description, up to the symbol before the next
    sign.  A symbol may contain spaces, but not where the text before it is a
    description already.  Descriptions end with their line.
    """
    parts = F.split(text, "=")
    long_, short = (rf"{lead}([{LETTERS}][{LETTERS}0-9{MARKS}{inner}]*)\s*$" for lead, inner in (("(?:^|\\s)", " "), ("\\s", "")))
    last = lambda i: i == F.size(parts) - 1
    piece = lambda i: F.element_at(parts, i + 1)

    def described(i: Column) -> Column:
        """The description after sign ``i``; null if there is none."""
        p = piece(i)
        said = F.trim(F.when(last(i), p).when(p.rlike(short), F.regexp_replace(p, short, "")))
        return F.when((said != "") & ~F.contains(said, F.lit("\n")), said)

    def symbol(i: Column) -> Column:
        p = piece(i - 1)
        before = F.when(i > 1, piece(F.greatest(i - 2, F.lit(0))).rlike(long_) & described(i - 1).isNotNull())
        return F.trim(F.when(F.coalesce(before, F.lit(False)), F.regexp_extract(p, short, 1)).otherwise(F.regexp_extract(p, long_, 1)))

    def made(i: Column) -> Column:
        said = F.regexp_replace(described(i), r"\.?,?$", "")
        tail = F.trim(F.regexp_replace(F.substring_index(said, ",", -1), r"\([^)]+\)\s*$", ""))
        unit = F.when(F.contains(said, F.lit(",")) & tail.isin(*UNITS), tail)
        head = F.substring(said, F.lit(1), F.length(said) - F.length(F.substring_index(said, ",", -1)) - 1)
        return F.struct(symbol(i).alias("symbol"), F.trim(F.when(unit.isNotNull(), head).otherwise(said)).alias("description"), unit.alias("unit"))

    found = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), made))
    ok = lambda s: (s["symbol"] != "") & (F.length(s["symbol"]) <= 15) & (F.length(s["description"]) >= 3) & ~F.lower(s["symbol"]).isin(*NO_SYMBOLS)
    return F.coalesce(F.filter(found, ok), F.expr("cast(array() as array<struct<symbol:string,description:string,unit:string>>)"))


def is_symbol_source(section: Column, title: Column, kind: Column, text: Column) -> Column:
    listed = section.rlike(r"^\d+\.[23]$") | F.upper(title).rlike("SYMBOL|NOTATION")
    return listed | ((kind == "text_block") & text.rlike(r"^[A-Za-z_]{1,5}\s*=\s*.{10,}")) | F.contains(F.lower(F.substring(text, 1, 20)), F.lit("where"))


def keep_longest(df: DataFrame, keys: list[str], text: str, order: list[str]) -> DataFrame:
    """The row of each key with the longest ``text``; the first in ``order`` where lengths tie."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(-F.length(text), *order)).alias("v"))
    return best.select(*keys, "v.*")


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("v")).select(*keys, "v.*")


def with_aliases(symbols: DataFrame, scope: list[str]) -> DataFrame:
    """Symbols written with spaces count without them too, unless that symbol is there."""
    bare = symbols.withColumn("symbol", F.replace("symbol", F.lit(" "), F.lit(""))).join(symbols.select(*scope, "symbol"), [*scope, "symbol"], "left_anti")
    return symbols.unionByName(keep_longest(bare, [*scope, "symbol"], "description", ["description"]).select(symbols.columns))


def variables(expression: Column) -> Column:
    """The variable-like tokens of a formula, sorted.

    Whole words of Latin letters, digits and underscores that begin with a letter; runs
    of Latin letters inside longer words, with what an underscore hangs on them; and
    every Greek letter.
    """
    words = F.filter(F.regexp_extract_all(expression, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: w.rlike("^[A-Za-z][A-Za-z0-9_]*$"))
    runs = F.regexp_extract_all(expression, F.lit("[A-Za-z]+(?:_[A-Za-z0-9]+)?"), F.lit(0))
    greek = F.regexp_extract_all(expression, F.lit(f"[{GREEK}]"), F.lit(0))
    return F.array_sort(F.array_except(F.array_distinct(F.concat(words, runs, greek)), F.array(*(F.lit(x) for x in NO_VARIABLES))))


def resolve_parameters(formulas: DataFrame, symbols: DataFrame, scope: list[str]) -> DataFrame:
    """(id, symbol, description, unit) of the variables a registry knows."""
    tokens = formulas.select(*scope, "id", F.explode(variables(F.col("expression"))).alias("symbol"))
    return tokens.join(symbols.select(*scope, "symbol", "description", "unit"), [*scope, "symbol"]).select("id", "symbol", "description", "unit")


def nearby_definitions(rows: DataFrame, doc: list[str], order: list[str], reach: int = 3) -> DataFrame:
    """(id, symbol, description): ``sym = text`` within ``reach`` rows of a formula; the first counts.

    ``rows``: doc..., order..., id, type, expression, text.
    """
    w = Window.partitionBy(*doc).orderBy(*order)
    # Only texts with an equals sign can define something; the others travel as ''.
    rows = rows.withColumn("text", F.when(F.contains("text", F.lit("=")), F.col("text")))
    around = rows.withColumn("_near", F.collect_list(F.struct(*order, F.coalesce("text", F.lit("")).alias("t"))).over(w.rowsBetween(-reach, reach)))
    formula = around.filter("type = 'formula'").withColumn("_vars", variables(F.col("expression")))
    own = F.struct(*order)
    texts = F.transform(F.filter("_near", lambda x: F.struct(*(x[o] for o in order)) != own), lambda x: x["t"])
    pattern = r"([A-Za-z][A-Za-z0-9_]*)\s*=\s*([^,;=]+)"
    found = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))))
    each = formula.select("id", "_vars", F.posexplode(found).alias("at", "m")).select(
        "id", "_vars", "at", F.trim(F.regexp_extract("m", pattern, 1)).alias("symbol"), F.trim(F.regexp_extract("m", pattern, 2)).alias("description")
    )
    some = each.filter(F.array_contains("_vars", F.col("symbol")) & (F.length("description") > 3))
    return some.groupBy("id", "symbol").agg(F.min_by("description", "at").alias("description"))


def symbol_conflicts(definitions: DataFrame, scope: list[str]) -> DataFrame:
    """Symbols with more than one description, over the raw definitions."""
    return definitions.groupBy(*scope, "symbol").agg(F.count_distinct("description").alias("n_descriptions")).filter("n_descriptions > 1")


def manifest(elements: DataFrame, by: list[str]) -> DataFrame:
    """(by..., n_elements, n_sections, tables, figures, equations): what each chapter holds."""

    def nums(kind: str, pattern: str) -> Column:
        num = F.nullif(F.regexp_extract("citation", pattern, 1), F.lit(""))
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col("type") == kind, num))), ",")

    return elements.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_elements"),
        F.count_distinct("section").alias("n_sections"),
        nums("table", r"(\d+\.\d+-\d+)").alias("tables"),
        nums("figure", r"(\d+\.\d+-\d+[A-D]?)").alias("figures"),
        nums("formula", r"(\d+\.\d+-\d+[a-z]?)").alias("equations"),
    )


def batch_summary(chapters: DataFrame) -> DataFrame:
    """One row over (passed, error, n_elements) of each chapter."""
    return chapters.agg(
        F.count_if(F.col("error").isNull() & F.col("passed")).alias("n_passed"),
        F.count_if(F.col("error").isNull() & ~F.col("passed")).alias("n_failed"),
        F.count("error").alias("n_errors"),
        F.sum("n_elements").alias("n_elements"),
    )
