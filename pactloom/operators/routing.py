"""From file names to target tables, formats and archive paths."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactloom.functions.text import basename, compact_timestamp, extension

# Folders a landed file moves to, and outcomes recorded for it.
PROCESSED_FOLDER = "processed"
PENDING_FOLDER = "schema_pending"
EXEMPTED_FOLDER = "exempted"
IGNORED_FOLDERS = ("processed/", "exempted/", "unprocessed/", "schema_pending/")
SUCCESS = "SUCCESS"
DRIFT_DETECTED = "DRIFT_DETECTED"
TABLE_MISSING = "TABLE_MISSING"
SKIPPED = "SKIPPED"
FAILED = "FAILED"
FORMATS = {"csv": "csv", "json": "json", "ndjson": "json", "parquet": "parquet"}

# What a rule that leaves a field out gets.
DEFAULT_DELIMITER = ","
DEFAULT_QUOTE = '"'
DEFAULT_SKIP_ROWS = 1
DEFAULT_DISPOSITION = "WRITE_APPEND"
DEFAULT_DOMAIN = "unknown_domain"

RULE_COLUMNS = (
    "file_pattern",
    "target_dataset",
    "target_table",
    "domain",
    "data_contracts",
    "file_format",
    "delimiter",
    "quote_char",
    "skip_header_rows",
    "write_disposition",
    "is_active",
    "created_at",
)

# Rules of one CASE expression; where there are more, names are joined with them.
RULES_PER_CASE = 500


def skip_paths(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Drops empty names, folder markers and names that contain a folder of handled files."""
    path = F.col(name)
    handled = reduce(lambda a, b: a | b, [path.contains(folder) for folder in IGNORED_FOLDERS])
    return files.where((path != "") & ~path.endswith("/") & ~handled)


def file_format(rule_format: Column, name: Column) -> Column:
    """Format the rule names, else the file's extension; lower case, without dots."""
    chosen = F.when(rule_format != "", F.lower(rule_format)).otherwise(extension(name))
    return F.replace(chosen, F.lit("."), F.lit(""))


def supported_format(fmt: Column) -> Column:
    return fmt.isin(*FORMATS)


def active_rules(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("is_active"))


def complete_rules(registry: DataFrame) -> DataFrame:
    """The registry with every known column present."""
    missing = {c: F.lit(None).cast("string") for c in RULE_COLUMNS if c not in registry.columns}
    return registry.withColumns(missing) if missing else registry


def _rule_struct(rules: DataFrame) -> Column:
    """A rule as a struct that sorts by precedence: oldest first, then by pattern."""
    rest = [c for c in RULE_COLUMNS if c not in ("created_at", "file_pattern")]
    return F.struct(
        F.col("created_at").isNull().alias("undated"), "created_at", "file_pattern", *rest
    )


def sound_rules(registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Active rules, and those of them that can't be applied: their pattern is NULL or no regex. Tasks compile them."""
    rules = active_rules(complete_rules(registry)).select(*RULE_COLUMNS)
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col("file_pattern"))
    tried = rules.withColumn("_sound", F.col("file_pattern").isNotNull() & compiled.isNotNull())
    return tried.where("_sound").drop("_sound"), tried.where("NOT _sound").drop("_sound")


def route_files(files: DataFrame, registry: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds the first active rule whose pattern is found in the name; NULLs where none is.

    Up to ``RULES_PER_CASE`` rules become one CASE expression in the order Spark sorts them, so routing needs no join
    with the files. More rules stay a table: most patterns need a text to stand at the beginning of the name or
    anywhere in it, and names are joined with rules by these texts; the pattern then decides. Rules without a pattern
    or with one that is no regex match nothing and are warned about; the others apply.
    """
    rules, unsound = sound_rules(registry)
    for rule in unsound.select("target_table", "file_pattern").toLocalIterator():
        warnings.warn(f"rule of {rule['target_table']} is left out: {rule['file_pattern']!r} is no pattern", stacklevel=2)
    first = _few(rules)
    if first is not None:
        if not first:
            return files.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rules.schema})
        matched = files.withColumn("_rule", _case(first, name))
        return matched.join(F.broadcast(_numbered(first, rules)), "_rule", "left").select(*files.columns, *RULE_COLUMNS)
    names = files.select(F.col(f"`{name}`").alias("_name"))
    best = _candidates(names, rules).groupBy("_name").agg(F.min(_rule_struct(rules)).alias("_best"))
    routed = files.join(best, F.col(f"`{name}`") == F.col("_name"), "left")
    return routed.select(*files.columns, *[F.col(f"_best.{c}").alias(c) for c in RULE_COLUMNS])


def _few(rules: DataFrame) -> list[Row] | None:
    """The rules by precedence, if they fit one CASE expression."""
    found = rules.orderBy(_rule_struct(rules)).limit(RULES_PER_CASE + 1).collect()
    return found if len(found) <= RULES_PER_CASE else None


def _case(ordered: list[Row], name: str) -> Column:
    """Number of the first rule whose pattern is found."""
    tests = [f"WHEN `{name}` RLIKE {_literal(r['file_pattern'])} THEN {i}" for i, r in enumerate(ordered)]
    return F.expr(f"CASE {' '.join(tests)} END")


def _numbered(ordered: list[Row], rules: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("_rule", T.IntegerType()), *rules.schema])
    return rules.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(ordered)], schema)


# Atoms of a pattern that stand for one character; a run of them ends before one that is repeated.
_ATOM = r"(?:[A-Za-z0-9_/ ,:;=@%&~<>!\"'#-]|\P{ASCII}|\\\p{Punct}|\[[.]\])"
_RUN = rf"({_ATOM}+)(?![*+?{{])"
# Texts to be found anywhere are looked up by their first characters: 4, 8, 16 or 32.
_SHORTEST, _LONGEST = 4, 32


def _needed_text(pattern: Column) -> tuple[Column, Column]:
    """What a name must begin with for a pattern to be found in it, and what it must contain; empty where unknown.

    Looked for are only plain characters at the beginning of patterns without alternatives (those of a simple group
    aside), flags or quoted parts. A needed text rules names out; that a name holds it decides nothing.
    """
    grouped = F.regexp_replace(pattern, r"\([^()\[\]\\]*\)", "")
    simple = ~grouped.contains("|") & ~pattern.contains("(?") & ~pattern.contains("\\Q")

    def run(text: Column, before: str) -> Column:
        found = F.regexp_extract(text, before + _RUN, 1)
        plain = F.regexp_replace(F.replace(found, F.lit("[.]"), F.lit(".")), r"\\(\p{Punct})", "$1")
        return F.when(simple, plain).otherwise("")

    return run(pattern, r"^\^"), run(F.regexp_replace(pattern, r"^\^?\.\*(?![*+?{])", ""), "^")


def _keyed(rules: DataFrame) -> DataFrame:
    """Rules with ``_at`` (``^`` at the beginning, ``*`` anywhere) and ``_text``, the text to look up; NULL for none."""
    begins, holds = _needed_text(F.col("file_pattern"))
    size = F.pow(F.lit(2), F.floor(F.log2(F.least(F.length("_holds"), F.lit(_LONGEST))))).cast("int")
    anywhere = F.when(F.length("_holds") >= _SHORTEST, F.substr(F.col("_holds"), F.lit(1), size))
    at_start = F.when(F.length("_begins") > 0, F.col("_begins"))
    keyed = rules.withColumns({"_begins": begins, "_holds": holds})
    keyed = keyed.withColumns({"_text": F.coalesce(at_start, anywhere), "_at": F.when(at_start.isNotNull(), "^").otherwise("*")})
    return keyed.drop("_begins", "_holds")


def _pieces(at: str, sizes: list[int]) -> Column:
    """Texts of the given sizes at the beginning of the name, or anywhere in it."""
    name = F.col("_name")

    def of_size(n: Column) -> Column:
        places = F.sequence(F.lit(1), F.lit(1) if at == "^" else F.length(name) - n + 1)
        return F.transform(places, lambda i: F.struct(F.lit(at).alias("_at"), F.substr(name, i, n).alias("_text")))

    fitting = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda n: n <= F.length(name))
    return F.flatten(F.transform(fitting, of_size))


def _candidates(names: DataFrame, rules: DataFrame) -> DataFrame:
    """``_name`` with each rule whose pattern is found in it."""
    keyed = _keyed(rules)
    rest = keyed.where("_text IS NULL").select(*RULE_COLUMNS)
    few = _few(rest)
    if few is None:
        # Nothing is known of these patterns, so every name is held against each.
        found = names.crossJoin(rest).where("_name RLIKE file_pattern")
    else:
        found = names.withColumn("_rule", _case(few, "_name") if few else F.lit(None).cast("int"))
        found = found.join(F.broadcast(_numbered(few, rules)), "_rule").drop("_rule")
    keyed = keyed.where("_text IS NOT NULL")
    sizes = keyed.select("_at", F.length("_text").alias("n")).distinct().collect()
    texts = [_pieces(at, [r["n"] for r in sizes if r["_at"] == at]) for at in ("^", "*")]
    pieces = names.select("_name", F.explode(F.array_distinct(F.concat(*texts))).alias("_piece")).select("_name", "_piece.*")
    # A registry of this size is no table to broadcast, whatever its files' size says.
    keyed = pieces.join(keyed.hint("merge"), ["_at", "_text"]).where("_name RLIKE file_pattern").select("_name", *RULE_COLUMNS)
    return found.select("_name", *RULE_COLUMNS).unionByName(keyed)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def archive_folder(status: Column) -> Column:
    return (
        F.when(status == SUCCESS, F.lit(PROCESSED_FOLDER))
        .when(status.isin(DRIFT_DETECTED, TABLE_MISSING), F.lit(PENDING_FOLDER))
        .otherwise(F.lit(EXEMPTED_FOLDER))
    )


def archive_path(folder: Column, name: Column, at: Column) -> Column:
    return F.concat(folder, F.lit("/"), basename(name), F.lit("_"), compact_timestamp(at))
