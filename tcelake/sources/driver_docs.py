"""Case documents assembled from the mapped driver rows as text (one document per case file).

The lines (and the lines with their parts) are dealt by order key once, as narrow rows; each becomes the text of its element in compiled code,
one ``groupBy`` on that key collects the texts, and the case leaves are joined on the same key. While the files are written, aggregations run
over the join's sorted rows (``spark.sql.execution.replaceHashWithSortAgg``): one document at a time, nothing nested is sorted or spilled. A document
holds only its own file's rows, like a case file on disk. NULL leaves are omitted from the XML, as a missing element. The text has the form that
``to_xml`` gives a nested struct of the same leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tcelake.schema import ROOT_TAG
from tcelake.sources.driver_tables import (
    ISOLATE_FLAG,
    ISOLATE_ORDER,
    MEASUREMENT_FLAGS,
    DriverSources,
    case_columns,
    file_of,
    isolate_columns,
    measurement_columns,
    treatment_columns,
)
from tcelake.sources.xml_docs import DEEP_ELEMENTS

MEASUREMENT_TAGS = ("baselineRNA", "pastRNA", "followupRNA", "baselineCD4", "pastCD4", "followupCD4")
ISOLATE_TAGS = {"baselineIsolate": "baseline", "pastIsolate": "past"}
TREATMENT_TAGS = {"baselineNewTreatment": "new", "pastRegimenTreatments": "past"}


def escaped(text: Column) -> Column:
    """Text as an XML parser gives it back."""
    for char, form in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#xd;")):
        text = F.replace(text, F.lit(char), F.lit(form))
    return text


def _open(tag: str | Column, depth: int, end: str = ">") -> Column:
    """The start tag on a line of its own."""
    head = "\n" + "    " * depth
    return F.lit(f"{head}<{tag}{end}") if isinstance(tag, str) else F.concat(F.lit(f"{head}<"), tag, F.lit(end))


def _close(tag: str | Column, depth: int | None = None) -> Column:
    """The end tag, on a line of its own where a depth is given."""
    head = "" if depth is None else "\n" + "    " * depth
    return F.lit(f"{head}</{tag}>") if isinstance(tag, str) else F.concat(F.lit(f"{head}</"), tag, F.lit(">"))


def _leaf(tag: str | Column, value: Column, depth: int) -> Column:
    """The element of a leaf; null where its value is."""
    return F.concat(_open(tag, depth), value, _close(tag))


def _element(tag: str | Column, depth: int, *parts: Column) -> Column:
    """The element around its parts, of which some are not null."""
    return F.concat(_open(tag, depth), F.concat_ws("", *parts), _close(tag, depth))


def _leaves(tag: str | Column, depth: int, *leaves: tuple[str | Column, Column]) -> Column:
    """The element around its leaves, an empty one where all of them are null."""
    return (F.when(F.coalesce(*[value for _, value in leaves]).isNull(), _open(tag, depth, "/>"))
             .otherwise(_element(tag, depth, *[_leaf(name, value, depth + 1) for name, value in leaves])))


#: Rows of ``_line_rows`` by use: lines as they are, and lines with each of their parts.
_LINE, _TREATMENT = 0, 1


def _line_rows(src: DriverSources) -> DataFrame:
    """``__use``, the columns of a line that a document needs and, for treatments, those of its part: one row per line with a flag that measurements
    or isolates have, and one per line and part. Narrow, so that one exchange by order serves all element kinds."""
    li = src.t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    part = src.t("part").select("p_partkey", "p_brand", "p_type", "p_size")
    plain = li.filter(F.col("l_returnflag").isin(*MEASUREMENT_FLAGS, ISOLATE_FLAG)).withColumn("__use", F.lit(_LINE))
    treated = li.join(part, li.l_partkey == part.p_partkey).drop("p_partkey", "l_partkey", "l_suppkey", "l_returnflag").withColumn("__use", F.lit(_TREATMENT))
    return plain.unionByName(treated, allowMissingColumns=True)


def _place(tag: Column, kinds: list[str]) -> Column:
    """Where elements of a kind stand in a document, from their tag."""
    return F.array_position(F.array(*map(F.lit, kinds)), tag)


def element_texts(rows: DataFrame) -> DataFrame:
    """``__key, __node``: the element of every line row, with what it is sorted by within its document. Each step computes what the next one uses
    several times: expressions that spell everything out become methods too large for the JVM to compile, and run interpreted."""
    tc, mc, ic = treatment_columns(), measurement_columns(), isolate_columns()
    treated, isolated = F.col("__use") == _TREATMENT, F.col("l_returnflag") == ISOLATE_FLAG
    tags = lambda kind, names: F.when(kind == list(names.values())[0], F.lit(list(names)[0])).otherwise(F.lit(list(names)[1]))
    rows = rows.select(
        F.col("l_orderkey").alias("__key"), "l_linenumber", "l_partkey", "l_suppkey", mc["relative_date"].alias("__rel"),
        F.when(treated, F.lit(2)).when(isolated, F.lit(1)).otherwise(F.lit(0)).alias("__kind"),
        F.when(treated, tags(tc["treatment_type"], TREATMENT_TAGS)).when(isolated, tags(ic["isolate_type"], ISOLATE_TAGS))
         .otherwise(mc["timepoint_tag"]).alias("__tag"),
        F.when(treated, tc["relative_stop_date"]).alias("__stop"), F.when(treated, tc["duration"]).alias("__duration"),
        F.when(treated, escaped(tc["drug_code"])).alias("__code"), F.when(treated, tc["drug_class"]).alias("__class"),
        F.when(isolated, F.coalesce(ic["has_mutation"], F.lit(False))).alias("__mutated"),
        F.when(~treated & ~isolated, mc["value_type"]).alias("__vtype"), F.when(~treated & ~isolated, mc["value"]).alias("__value"))
    tag, rel, kind = F.col("__tag"), F.col("__rel"), F.col("__kind")
    part_texts = rows.select(
        "__key", "l_linenumber", "l_partkey", "l_suppkey", "__rel", "__kind", "__tag", "__mutated", "__vtype", "__value",
        F.when(kind == 2, F.concat_ws("", _leaf("relativeStartDate", rel, 2), _leaf("relativeStopDate", F.col("__stop"), 2), _leaf("duration", F.col("__duration"), 2),
                                      _leaves("drug", 2, ("drugCode", F.col("__code")), ("drugClass", F.col("__class"))))).alias("__treatment"),
        F.when(kind == 1, F.concat_ws("", _leaf("gene", ic["gene"], 2), _leaf("subtype", ic["subtype"], 2), _leaf("relativeDate", rel, 2), _leaf("aaStart", ic["aa_start"], 2),
                                      _leaf("aaStop", ic["aa_stop"], 2), _leaf("aaSequence", ic["aa_sequence"], 2),
                                      _leaf("nucleotideSequence", ic["nucleotide_sequence"], 2))).alias("__isolate"),
        F.when(F.col("__mutated"), _leaves("aaMutation", 2, ("position", ic["position"]), ("aminoAcid", ic["amino_acid"]), ("mixtures", ic["mixtures"]))).alias("__mutation"))
    text = (F.when(kind == 2, _element(tag, 1, F.col("__treatment"))).when(kind == 1, _element(tag, 1, F.col("__isolate"), F.col("__mutation")))
             .otherwise(_leaves(tag, 1, (F.col("__vtype"), F.col("__value")), ("relativeDate", rel))))
    return part_texts.select("__key", F.struct(
        F.coalesce(F.when(kind == 0, _place(tag, list(MEASUREMENT_TAGS))), F.when(kind == 1, _place(tag, list(ISOLATE_TAGS)) + 10),
                   _place(tag, list(TREATMENT_TAGS)) + 20).alias("place"),
        *[F.when(kind == 1, F.col(c)).alias(c) for c in ISOLATE_ORDER], rel.alias("rel"), F.col("__mutated").alias("mutated"), text.alias("text")).alias("__node"))


def case_documents(src: DriverSources) -> DataFrame:
    """(xml_filename, xml STRING) — the case files' text."""
    cc = case_columns()
    case = src.t("orders").select(
        F.col("o_orderkey").alias("__key"),
        F.concat_ws("", _leaves("patient", 1, ("patientAlias", cc["patient_alias"]), ("CD4NadirBeforeTCE", cc["cd4_nadir_before_tce"])),
                    _leaf("baselineYear", cc["baseline_year"], 1), _leaf("dateUnit", cc["date_unit"], 1),
                    _leaf("schemaVersion", cc["schema_version"], 1)).alias("__case"))
    lines, dates = _line_rows(src), src.t("orders").select("o_orderkey", "o_orderdate")
    # Dealt before the join whatever its kind, so that lists are made once, behind the exchange; sorted as the aggregation wants its rows (which
    # a sort-merge join has done already). Nodes are made in compiled code below the sort: aggregations evaluate theirs interpreted.
    rows = lines.repartition("l_orderkey").join(dates, lines.l_orderkey == dates.o_orderkey)
    elements = element_texts(rows).sortWithinPartitions("__key").groupBy("__key").agg(F.collect_list("__node").alias("__nodes"))
    joined = case.join(elements, "__key", "left")
    return joined.select(file_of(F.col("__key")).alias("xml_filename"),
                         F.concat_ws("", F.lit(f"<{ROOT_TAG}>"), "__case", F.sort_array("__nodes")["text"], F.lit(f"\n</{ROOT_TAG}>")).alias("xml"))


def varied_documents(text: DataFrame) -> DataFrame:
    """``xml_filename, content``: the case documents as files of many forms that mean the same to a strict reader.

    Of every 7th file the repeatable elements stand below two wrappers; every 11th holds ``<tce>`` and closing tags in CDATA and
    comments; every 17th has elements that are none of the documented ones (other case, another namespace) before the real ones;
    of every 19th a leaf is followed by a second one and holds a child element after its text; of every 23rd the RNA nodes have a ``vLoadMatch``;
    of every 29th they have an empty leaf beside the filled one, or a second one after it. By their number
    modulo 13 files declare and use windows-1252 (with letters beyond ASCII in an element nobody reads), UTF-16 with a byte-order
    mark, ISO-8859-1, or UTF-8 with one."""
    key = F.col("__key")
    text = text.withColumn("__key", F.regexp_extract("xml_filename", r"^(\d+)", 1).cast("long"))
    forms = [
        (7, rf"(?s)(<(?:{'|'.join(DEEP_ELEMENTS)})[\s/>].*)</tce>", "<visit><part>$1</part></visit></tce>"),
        (11, r"</tce>\s*$", "<note><![CDATA[<tce></tce> <pastCD4>]]></note><!-- <aaMutation> --></tce>\n"),
        (19, r"<schemaVersion>([^<]*)</schemaVersion>",
         "<schemaVersion>$1<b>0</b>0</schemaVersion><schemaVersion>second</schemaVersion>"),
        (23, r"<(baseline|past|followup)RNA>", "<$1RNA><vLoadMatch>=</vLoadMatch>"),
        (29, r"</logLoad>", "</logLoad><logLoad>9</logLoad>"),
        (29, r"</rawLoad>", "</rawLoad><logLoad/>"),
        (17, r"^<tce>", '<tce xmlns:o="urn:other"><BaselineYear>1</BaselineYear><o:dateUnit>years</o:dateUnit>'
                        "<BASELINECD4><count>1</count></BASELINECD4><o:pastRNA><logLoad>1</logLoad></o:pastRNA>"),
    ]
    for every, pattern, form in forms:
        text = text.withColumn("xml", F.when(key % every == 0, F.regexp_replace("xml", pattern, form)).otherwise(F.col("xml")))
    x = F.col("xml")
    place = F.lit("<place>Zo\u00eb caf\u00e9</place></tce>")
    named = lambda charset: F.concat(F.lit(f'<?xml version="1.0" encoding="{charset}"?>\n'),
                                     F.regexp_replace(x, r"</tce>\s*$", place), F.lit("\n<?checked yes?>"))
    # Both charsets have the bytes of ISO-8859-1 for these letters.
    content = (F.when(key % 13 == 0, F.encode(named("windows-1252"), "ISO-8859-1"))
                .when(key % 13 == 1, F.encode(named("UTF-16"), "UTF-16"))
                .when(key % 13 == 2, F.encode(named("ISO-8859-1"), "ISO-8859-1"))
                .when(key % 13 == 3, F.concat(F.unhex(F.lit("EFBBBF")), x.cast("binary")))
                .otherwise(x.cast("binary")))
    return text.select("xml_filename", content.alias("content"))


_CORPUS: dict[tuple, str] = {}


def driver_corpus(spark, sf_dir: str) -> DataFrame:
    """``xml_filename, content``: the generated case files of one driver directory, written once per session to the shared
    checkpoint folder, the stand-in for a folder of case files."""
    from tcelake.session import checkpoint_root, scratch_dir, setting
    key = (checkpoint_root(spark), sf_dir.rstrip("/"))
    if key not in _CORPUS:
        path = scratch_dir(spark, "corpus")
        # A stage whose loop the JVM will not compile (8,000 bytes of code) is run operator by operator, in methods that it compiles.
        with setting(spark, "spark.sql.execution.replaceHashWithSortAgg", "true"), setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000"):
            varied_documents(case_documents(DriverSources(spark, sf_dir))).write.mode("overwrite").option("compression", "zstd").parquet(path)
        _CORPUS[key] = path
    return spark.read.parquet(_CORPUS[key])
