"""Portal configurations: JSON files to a page plan.

Each file is one JSON object::

    {"name": "...", "metadata": {...},
     "pages": [{"url": "...", "metadata": {...}, "pagination": {...}}],
     "components": {"scraper": {"factory": "...", "options": {"listing": {...}, "article": {...},
                                                               "pagination": {...}}},
                    "url_normalizer": {...}, "date_normalizer": {...}, "text_cleaner": {...},
                    "deduper": {...}, "writer": {...}}}

Factories are required text but are not loaded: the options configure the Spark job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas as S
from newsloom.functions.metadata import has_key, merge_maps, set_default
from newsloom.functions.tags import normalize_list, split_tags
from newsloom.functions.text import strip
from newsloom.session import Staging, stage

# The sections every configuration must hold.
COMPONENTS = ("scraper", "url_normalizer", "date_normalizer", "text_cleaner", "deduper", "writer")

_S = T.StringType()
_PAGE = T.StructType(
    [
        T.StructField("url", _S),
        T.StructField("metadata", S.STRING_MAP),
        T.StructField("pagination", S.PAGINATION_TEXT),
    ]
)
_TAG_LIST = T.StructType([T.StructField("tags", S.STRING_LIST)])
_CONFIG = T.StructType(
    [
        T.StructField("name", _S),
        T.StructField("metadata", S.STRING_MAP),
        T.StructField("pages", T.ArrayType(_PAGE)),
    ]
)
# The same metadata read a second time, where `tags` may be a list.
_CONFIG_TAGS = T.StructType(
    [
        T.StructField("metadata", _TAG_LIST),
        T.StructField("pages", T.ArrayType(T.StructType([T.StructField("metadata", _TAG_LIST)]))),
    ]
)


def config_files(
    spark: SparkSession, paths: Sequence[str] = (), directory: str | None = None
) -> list[str]:
    """File URIs in load order: the given files, then ``*.json`` below the directory by name.

    Each file appears once. Only the file index is read here, no content.
    """
    ordered = [uri for path in paths for uri in spark.read.text(path).inputFiles()]
    if directory:
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        ordered += sorted(reader.text(directory).inputFiles())
    if not ordered:
        raise ValueError("no portal configuration given")
    return list(dict.fromkeys(ordered))


def read_configs(
    spark: SparkSession, paths: Sequence[str] = (), directory: str | None = None
) -> DataFrame:
    """One row per config file: ``portal_idx``, ``file`` and its ``text``.

    Every file is opened once and its row is written to the shared folder. Given paths are few
    and named one by one; the files of the directory are found, read and numbered by Spark. Rows
    are small and their rules take long, so they are dealt to all cores whatever their bytes.
    """
    keep, given = Staging(spark), config_files(spark, paths) if paths else []
    if not given and not directory:
        raise ValueError("no portal configuration given")
    read = lambda texts: texts.select(F.input_file_name().alias("file"), F.col("value").alias("text"))
    parts = []
    if given:
        order = spark.createDataFrame(list(enumerate(given)), "portal_idx int, file string")
        # The index gives escaped URIs; paths are read as they are.
        texts = read(spark.read.text([unquote(file) for file in given], wholetext=True))
        parts.append(keep(texts.join(order, "file").select("portal_idx", "file", "text"), "configs"))
    if directory:
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        texts = read(reader.text(directory, wholetext=True))
        found = keep(texts.where(~F.col("file").isin(given)) if given else texts, "configs")
        parts.append(_numbered(found, len(given), keep))
    configs = reduce(DataFrame.unionByName, parts)
    configs = keep(configs.repartition(2 * spark.sparkContext.defaultParallelism, "portal_idx"), "configs")
    if configs.isEmpty():
        raise ValueError("no portal configuration given")
    return configs


def _numbered(texts: DataFrame, first: int, keep: Staging) -> DataFrame:
    """``texts`` with ``portal_idx`` from ``first`` on, by the order of the names.

    Names are sorted in ranges; a name's number is its place in its range and the sizes of the
    ranges before it, of which there are as many as tasks.
    """
    ranges = texts.select("file").repartitionByRange("file").select("file", F.spark_partition_id().alias("part"))
    names = keep(ranges, "names")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = names.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("file")) - 1
    numbers = names.withColumn("place", place).join(F.broadcast(sizes), "part")
    numbers = numbers.select("file", (F.col("before") + F.col("place") + first).cast("int").alias("portal_idx"))
    return texts.join(numbers, "file").select("portal_idx", "file", "text")


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("MISSING")), r"^[A-Z]+", 0)


def _get(value: Column, path: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, path, as_type)


# Kinds of a variant that are whole numbers.
_WHOLE = ("TINYINT", "SMALLINT", "INT", "INTEGER", "BIGINT")
_ABSENT = ("MISSING", "VOID")
NUMBERS = ("start", "stop", "step", "count", "limit")


def _is_whole(value: Column) -> Column:
    """A whole number of 32 bits, or one written as text."""
    return _kind(value).isin(*_WHOLE, "STRING") & F.trim(_get(value, "$", "string")).try_cast("int").isNotNull()


def _pagination_rules() -> list[tuple[str, Callable[[Column], Column]]]:
    """Rules that a pagination setting breaks, each a function of the setting."""
    at = lambda p, name: _get(p, f"$.{name}")
    given = lambda p, name: ~_kind(at(p, name)).isin(*_ABSENT)
    pages = lambda p: _get(p, "$.pages", "array<variant>")
    number = lambda name: lambda p: given(p, name) & ~_is_whole(at(p, name))
    return [
        ("pagination must be an object", lambda p: ~_kind(p).isin("OBJECT", *_ABSENT)),
        *[(f"pagination {name} must be a whole number", number(name)) for name in NUMBERS],
        ("pagination limit must not be negative", lambda p: F.coalesce(F.trim(_get(p, "$.limit", "string")).try_cast("int") < 0, F.lit(False))),
        (
            "pagination pages must be a list of whole numbers",
            lambda p: given(p, "pages") & ((_kind(at(p, "pages")) != "ARRAY") | F.exists(pages(p), lambda x: ~_is_whole(x))),
        ),
        ("pagination param must be text", lambda p: given(p, "param") & (_kind(at(p, "param")) != "STRING")),
        ("pagination params must be an object", lambda p: given(p, "params") & (_kind(at(p, "params")) != "OBJECT")),
    ]


def _broken_by(rule: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda setting: F.coalesce(rule(setting), F.lit(False))


def config_violations(configs: DataFrame) -> DataFrame:
    """``(file, rule)`` for every broken rule; an empty result means all configs are valid."""
    doc = F.try_parse_json("text")
    is_object = _kind(doc) == "OBJECT"
    at = lambda path: _kind(_get(doc, path))
    blank = lambda path: (at(path) != "STRING") | (
        strip(F.coalesce(_get(doc, path, "string"), F.lit(""))) == ""
    )
    optional_object = lambda path: ~at(path).isin("OBJECT", "MISSING")

    pages = F.coalesce(_get(doc, "$.pages", "array<variant>"), F.array().cast("array<variant>"))
    rules: list[tuple[str, Column]] = [
        ("config must be an object", ~is_object),
        ("name is required", is_object & blank("$.name")),
        ("pages must be a list", is_object & ~at("$.pages").isin("ARRAY", "MISSING")),
        ("every page must be an object", is_object & F.exists(pages, lambda p: _kind(p) != "OBJECT")),
        (
            "page metadata must be an object",
            is_object & F.exists(pages, lambda p: ~_kind(_get(p, "$.metadata")).isin("OBJECT", "MISSING", "VOID")),
        ),
        ("metadata must be an object", is_object & optional_object("$.metadata")),
        ("components is required", is_object & (at("$.components") != "OBJECT")),
    ]
    for name in COMPONENTS:
        path = f"$.components.{name}"
        rules += [
            (f"component {name} is required", is_object & (at(path) != "OBJECT")),
            (f"component {name} needs a factory", is_object & (at(path) == "OBJECT") & blank(f"{path}.factory")),
            (f"component {name} options must be an object", is_object & optional_object(f"{path}.options")),
        ]
    default = _get(doc, "$.components.scraper.options.pagination")
    settings = F.array_append(F.transform(pages, lambda p: _get(p, "$.pagination")), default)
    for rule, breaks in _pagination_rules():
        rules.append((rule, is_object & F.exists(settings, _broken_by(breaks))))
    broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(rule)) for rule, bad in rules]))
    return configs.select("file", F.explode(broken).alias("rule"))


def _tags(text_map: Column, listed: Column) -> Column:
    """Tags of one metadata level; null when the level has none."""
    found = F.when(listed.isNotNull(), normalize_list(listed)).otherwise(
        split_tags(F.try_element_at(text_map, F.lit("tags")))
    )
    return F.when(has_key(text_map, "tags"), found)


def build_page_plan(
    configs: DataFrame, pages_override: Sequence[Mapping[str, object]] | None = None
) -> DataFrame:
    """The page plan of valid configs (:data:`newsloom.schemas.PAGES_PLAN`).

    Page metadata is the portal's overridden by the page's, with ``portal_name`` set when absent.
    An override replaces the pages of every portal.
    """
    doc = F.try_parse_json("text")
    options = lambda name, path="": _get(doc, f"$.components.{name}.options{path}")
    texts = configs
    pages_text = F.col("text") if pages_override is None else F.lit(json.dumps({"pages": list(pages_override)}))

    fields_text = _get(doc, "$.components.deduper.options.fields", "string")
    fields_list = _get(doc, "$.components.deduper.options.fields", "array<string>")
    listing_keys = (
        "item_selector", "link_selector", "url_attribute", "title_selector", "summary_selector", "metadata_selectors",
    )
    article_keys = ("body_selector", "title_selector", "metadata_selectors")
    listing = F.to_json(F.struct(*[options("scraper", f".listing.{k}").alias(k) for k in listing_keys]))
    article = F.to_json(
        F.struct(
            *[options("scraper", f".article.{k}").alias(k) for k in article_keys],
            options("text_cleaner", ".allowed_tags").alias("allowed_tags"),
        )
    )
    portals = texts.select(
        "portal_idx",
        F.from_json("text", _CONFIG).alias("config"),
        F.from_json("text", _CONFIG_TAGS).alias("config_tags"),
        F.from_json(pages_text, _CONFIG)["pages"].alias("pages"),
        F.from_json(pages_text, _CONFIG_TAGS)["pages"].alias("pages_tags"),
        F.from_json(F.to_json(options("scraper", ".pagination")), S.PAGINATION_TEXT).alias("portal_pagination"),
        listing.alias("listing_options"),
        article.alias("article_options"),
        _get(doc, "$.components.url_normalizer.options.default_base_url", "string").alias("default_base"),
        F.coalesce(
            fields_list,
            F.filter(F.transform(F.split(fields_text, ","), strip), lambda f: f != ""),
        ).alias("fp_fields"),
        F.coalesce(_get(doc, "$.components.deduper.options.prefix", "string"), F.lit("")).alias("fp_prefix"),
    )
    pages = portals.select("*", strip(F.col("config.name")).alias("portal"), F.posexplode("pages").alias("pos", "page"))
    page_meta = merge_maps(F.col("config.metadata"), F.col("page.metadata"))
    page_listed = F.get(F.col("pages_tags"), F.col("pos"))["metadata"]["tags"]
    tags = F.coalesce(
        _tags(F.col("page.metadata"), page_listed),
        _tags(F.col("config.metadata"), F.col("config_tags.metadata.tags")),
    )
    return pages.select(
        "portal_idx",
        "portal",
        (F.col("pos") + 1).cast("int").alias("page_index"),
        F.coalesce(F.col("page.url"), F.lit("")).alias("page_url"),
        set_default(page_meta, "portal_name", F.col("portal")).alias("page_meta"),
        tags.alias("page_tags"),
        F.coalesce(_usable(F.col("page.pagination")), _usable(F.col("portal_pagination"))).alias("pagination"),
        "listing_options",
        "article_options",
        "default_base",
        "fp_fields",
        "fp_prefix",
    )


def _usable(pagination: Column) -> Column:
    """Typed pagination: numbers written as text count; an empty object counts as none."""
    numbers = NUMBERS
    whole = lambda text: F.trim(text).try_cast("int")
    typed = F.struct(
        pagination["param"].alias("param"),
        *[whole(pagination[name]).alias(name) for name in numbers],
        F.transform(pagination["pages"], whole).alias("pages"),
        pagination["params"].alias("params"),
    )
    given = [pagination[name] for name in ("param", *numbers)]
    some = F.coalesce(*given, F.to_json(pagination["pages"]), F.to_json(pagination["params"]))
    return F.when(some.isNotNull(), typed)


def load_page_plan(
    spark: SparkSession,
    paths: Sequence[str] = (),
    directory: str | None = None,
    pages_override: Sequence[Mapping[str, object]] | None = None,
) -> DataFrame:
    """Read, validate and plan; any broken rule fails the job before work starts."""
    configs = read_configs(spark, paths, directory)
    broken = stage(config_violations(configs), "violations")
    if count := broken.count():
        found = (f"{r.file}: {r.rule}" for r in broken.orderBy("file", "rule").toLocalIterator())
        raise ValueError(f"invalid portal configuration ({count} broken rules): " + "; ".join(found))
    return build_page_plan(configs, pages_override)
