"""The thirteen sources, each as a composition of a few steps over its raw frames.

Small crosswalks arrive as frames too; Spark broadcasts them by their size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrid.functions.scalar import age_group, any_of, extract, first_case, get, months_to_years, range_mean, replaced, split_multi, uri_tail
from claimgrid.operators.aggregate import first_by
from claimgrid.operators.ontology import PSEUDO_CONTROLS
from claimgrid.operators.reshape import exploded, split_fields
from claimgrid.schema import CONTROL_ID, CONTROL_NAME, CROWD, EXPERT, NA
from claimgrid.sources.registry import Context, source

# Spellings of the sexes, and the names they get.
SEX_KEYS = {"male": "M", "m": "M", "female": "F", "f": "F"}
SEX_NAMES = {"M": "male", "F": "female"}


def claims(df: DataFrame, accession: str, attribute: str | Column, term_id: Column, term_name: Column, ecode: str = EXPERT) -> DataFrame:
    attribute = F.lit(attribute) if isinstance(attribute, str) else attribute
    return df.select(F.col(f"`{accession}`").alias("accession"), attribute.alias("attribute"), term_id.alias("term_id"), term_name.alias("term_name"), F.lit(ecode).alias("ecode"))


def together(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def inside(df: DataFrame, column: str, terms: DataFrame, or_controls: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose term is a descendant of the systems, and the controls named."""
    kept = df.join(terms.select(F.col("term").alias(column)), column, "left_semi").select(*df.columns)
    return kept.unionByName(df.where(F.col(column).isin(*or_controls))) if or_controls else kept


def crosswalk(df: DataFrame, column: str, mapping: DataFrame, key: str, **values: str) -> DataFrame:
    """Left join with a small map; values: new column -> the map's column."""
    own = mapping.select(F.col(key).alias("_key"), *(F.col(v).alias(n) for n, v in values.items()))
    return df.join(own, F.col(f"`{column}`") == F.col("_key"), "left").drop("_key")


def mapped_disease(df: DataFrame, ids: Column, mapping: DataFrame, out: str = "mondo") -> DataFrame:
    """Foreign disease ids to disease terms: pseudo ids to the control, unmapped to NA."""
    k, v = mapping.columns
    joined = df.withColumn("_id", ids).join(mapping.select(F.col(k).alias("_k"), F.col(v).alias("_v")), F.col("_id") == F.col("_k"), "left")
    return joined.withColumn(out, F.when(F.col("_id").isin(*PSEUDO_CONTROLS), CONTROL_ID).otherwise(F.coalesce("_v", F.lit(NA)))).drop("_id", "_k", "_v")


def named(df: DataFrame, column: str, names: DataFrame, out: str = "name") -> DataFrame:
    return crosswalk(df, column, names, "id", **{out: "name"})


def ages(df: DataFrame, accession: str, years: Column) -> DataFrame:
    binned = df.withColumn("_age", age_group(years)).where("_age is not null")
    return claims(binned, accession, "age", F.col("_age"), F.col("_age"))


def sexes(df: DataFrame, accession: str, sex: Column) -> DataFrame:
    """Any of the spellings counts, in either case."""
    own = df.withColumn("_sex", replaced(F.lower(F.trim(sex)), SEX_KEYS)).where(F.col("_sex").isin("M", "F"))
    return claims(own, accession, "sex", F.col("_sex"), replaced(F.col("_sex"), SEX_NAMES))


@source("ALE")
def ale(ctx: Context, raw: DataFrame, tissues: DataFrame) -> DataFrame:
    """raw: accession, brenda, age_months, gender. tissues: brenda, uberon, uberon_name. Unmapped tissues drop the row."""
    own = raw.distinct().join(tissues.select("brenda", "uberon", "uberon_name"), "brenda")
    return together(
        claims(inside(own, "uberon", ctx.tissues), "accession", "tissue", F.col("uberon"), F.col("uberon_name")),
        sexes(own.where(F.col("gender").isin("F", "M")), "accession", F.col("gender")),
        ages(own, "accession", months_to_years(F.col("age_months").try_cast("double"))),
    )


@source("BGee")
def bgee(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: the library tables of all species. Stages are kept here and dropped by the attribute list later."""
    own = raw.select(
        F.col("`Run IDs`").alias("accession"), F.col("`Expression mapped anatomical entity ID`").alias("tissue"), F.col("`Expression mapped anatomical entity name`").alias("tissue_name"),
        F.col("`Expression mapped stage ID`").alias("stage"), F.col("`Expression mapped stage name`").alias("stage_name"), F.col("`Expression mapped sex`").alias("sex"),
    )
    own = exploded(own, "accession")
    return together(
        claims(inside(own, "tissue", ctx.tissues), "accession", "tissue", F.col("tissue"), F.col("tissue_name")),
        sexes(own.where(F.col("sex").isin("male", "female")), "accession", F.col("sex")),
        claims(own.where("stage <> ''"), "accession", "developmental_stage", F.col("stage"), F.col("stage_name")),
    )


@source("Cello")
def cello(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: key, value (array of term ids). Terms without a name are dropped."""
    own = named(raw.select(F.col("key").alias("accession"), F.explode("value").alias("term")), "term", ctx.names).where("name is not null")
    return claims(inside(own, "term", ctx.tissues), "accession", "tissue", F.col("term"), F.col("name"))


@source("CREEDS")
def creeds(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: organism, do_id, disease_name, pert_ids, ctrl_ids. Controls count only for signatures that are kept."""
    own = raw.where((F.col("organism") == "human") & F.col("do_id").startswith("DOID:"))
    own = inside(mapped_disease(own, F.col("do_id"), ctx.to_disease["DOID"]), "mondo", ctx.diseases)
    cases = own.select(F.explode("pert_ids").alias("accession"), "mondo", F.coalesce("disease_name", F.lit("unknown")).alias("name"))
    controls = own.select(F.explode("ctrl_ids").alias("accession"))
    return together(
        claims(cases, "accession", "disease", F.col("mondo"), F.col("name"), CROWD),
        claims(controls, "accession", "disease", F.lit(CONTROL_ID), F.lit(CONTROL_NAME), CROWD),
    )


# The eleven fields of a signature's description, in order.
SIGNATURE = ["gse", "controls", "cases", "platform", "field_4", "disease", "disease_id", "tissue", "datasource", "strategy", "organism"]


@source("DiSignAtlas")
def disign_atlas(ctx: Context, raw: DataFrame, tissues: DataFrame, corrections: DataFrame) -> DataFrame:
    """raw: name, description. tissues: name, id. corrections: sample, term, name; the first of a sample counts."""
    own = split_fields(raw, "description", SIGNATURE)
    cases = exploded(own.withColumn("accession", F.col("cases")), "accession", ";")
    controls = exploded(own.withColumn("accession", F.col("controls")), "accession", ";").withColumns({"disease": F.lit("control"), "disease_id": F.lit("C0000000")})
    both = together(cases, controls).where(F.col("accession").startswith("GSM"))
    both = inside(mapped_disease(both, F.concat(F.lit("UMLS:"), "disease_id"), ctx.to_disease["UMLS"]), "mondo", ctx.diseases, (CONTROL_ID,))
    with_tissue = both.where("tissue is not null and tissue <> 'None'").withColumn("tissue", F.lower("tissue"))
    with_tissue = crosswalk(with_tissue, "tissue", tissues, "name", term="id")
    first = first_by(corrections.withColumn("_pos", F.monotonically_increasing_id()), ["sample"], [F.col("_pos")])
    with_tissue = crosswalk(with_tissue, "accession", first, "sample", own_term="term", own_name="name")
    return together(
        claims(both, "accession", "disease", F.col("mondo"), F.lower("disease")),
        claims(with_tissue, "accession", "tissue", F.coalesce("own_term", "term", F.lit("na")), F.coalesce("own_name", "tissue")),
    )


# Categories of characteristics, and the sexes' ids.
CATEGORIES = {"disease": "disease", "disease model": "disease", "cell type": "tissue", "developmental stage": "age", "organism part": "tissue", "biological sex": "sex"}
PATO_SEXES = {"PATO:0000384": "M", "PATO:0000383": "F"}
LATE_ADULT_STAGE = "UBERON:0007222"


@source("Gemma")
def gemma(ctx: Context, raw: DataFrame, stages: DataFrame) -> DataFrame:
    """raw: accession, characteristics (array of category, valueUri, value). stages: term_id, age_group."""
    each = raw.where(F.col("accession").startswith("GSE")).select("accession", F.explode("characteristics").alias("c")).select("accession", "c.*")
    each = each.where(F.col("category").isin(*CATEGORIES) & (F.col("valueUri") != "") & (F.col("value") != ""))
    own = each.select("accession", replaced(F.col("category"), CATEGORIES).alias("attribute"), uri_tail(F.col("valueUri")).alias("term"), F.lower("value").alias("name"))
    own = crosswalk(own, "term", stages.where("age_group is not null and age_group <> 'na'"), "term_id", age="age_group")
    own = own.where("attribute <> 'age' or age is not null")
    own = own.withColumn("term", F.when(F.col("attribute") == "age", F.col("age")).when(F.col("attribute") == "sex", replaced(F.col("term"), PATO_SEXES)).otherwise(F.col("term"))).drop("age").distinct()
    own = own.where(~((F.col("attribute") == "sex") & (F.col("term") == LATE_ADULT_STAGE)))
    rest = own.where("attribute not in ('tissue', 'disease')")
    kept = together(rest, inside(own.where("attribute = 'tissue'"), "term", ctx.tissues), inside(own.where("attribute = 'disease'"), "term", ctx.diseases))
    return claims(kept, "accession", F.col("attribute"), F.col("term"), F.col("name"))


@source("Golightly_2018")
def golightly(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: accession, tissue, tissue_name, age, sex of all files, by a table of what each file is about (``golightly_rows``).
    A file's tissue counts if it is a descendant of the systems; its ages and sexes count anyway."""
    age = F.when(F.col("age").contains("-"), range_mean(F.col("age"))).otherwise(F.col("age").try_cast("double"))
    return together(
        claims(inside(raw, "tissue", ctx.tissues), "accession", "tissue", F.col("tissue"), F.col("tissue_name")), sexes(raw, "accession", F.col("sex")), ages(raw, "accession", age)
    ).distinct()


def golightly_rows(members: DataFrame, files: DataFrame) -> DataFrame:
    """accession, tissue, tissue_name, age, sex from rows of a ZIP's tables (file, row: a map of its fields).

    files: file, tissue, tissue_name, age_column, sex_column (empty or null: none). Unlisted files and rows without a sample
    id are left out.
    """
    field = lambda name: F.try_element_at("row", F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("\0"))).alias(name.removesuffix("_column"))
    own = members.join(files, "file").select(F.try_element_at("row", F.lit("SampleID")).alias("accession"), "tissue", "tissue_name", field("age_column"), field("sex_column"))
    return own.where("accession is not null")


@source("Gu_2023")
def gu(ctx: Context, raw: DataFrame, diseases: DataFrame, tissues: DataFrame) -> DataFrame:
    """raw: Sample ID, Manual annotation, Sample info #manual annotation. diseases: disease_name, mondo_id. tissues: tissue_name, uberon_id."""
    own = raw.select(F.col("`Sample ID`").alias("accession"), F.col("`Manual annotation`").alias("tissue"), F.col("`Sample info #manual annotation`").alias("disease"))
    sick = inside(crosswalk(own, "disease", diseases, "disease_name", term="mondo_id"), "term", ctx.diseases)
    where = inside(crosswalk(own, "tissue", tissues, "tissue_name", term="uberon_id"), "term", ctx.tissues)
    return together(claims(sick, "accession", "disease", F.col("term"), F.col("disease")), claims(where, "accession", "tissue", F.col("term"), F.col("tissue")))


#: How the RNA-seq part spells the control: with six zeros, so it isn't the control's id.
SIX_ZEROS = "MONDO:000000"


def _johnson_common(own: DataFrame) -> DataFrame:
    aged = own.where("age_group is not null and age_group <> 'na'").withColumn("_age", replaced(F.col("age_group"), {"elderly": "elderly_adult"}))
    return together(sexes(own.where(F.col("sex").isin("male", "female", "M", "F")), "accession", F.col("sex")), claims(aged, "accession", "age", F.col("_age"), F.col("_age")))


def _johnson_tissue(ctx: Context, own: DataFrame, ids: str) -> DataFrame:
    each = named(inside(exploded(own.where(f"`{ids}` is not null"), ids), ids, ctx.tissues).select("accession", ids).distinct(), ids, ctx.names)
    return claims(each, "accession", "tissue", F.col(ids), F.col("name"))


@source("Johnson_2023_microarray", of="Johnson_2023")
def johnson_microarray(ctx: Context, raw: DataFrame, diseases: DataFrame, tissues: DataFrame) -> DataFrame:
    """raw: gsm, disease, tissue (MESH:Name items), sex, age_group. diseases: mesh_id, mondo_id, mondo_name. tissues: mesh_id, uber_id."""
    own = raw.withColumnRenamed("gsm", "accession")
    sick = exploded(own, "disease").withColumn("mesh", get(F.split("disease", ":"), 0))
    sick = inside(crosswalk(sick, "mesh", diseases, "mesh_id", term="mondo_id", name="mondo_name"), "term", ctx.diseases)
    where = exploded(own, "tissue").withColumn("mesh", get(F.split("tissue", ":"), 0))
    return together(
        claims(sick, "accession", "disease", F.col("term"), F.col("name")),
        _johnson_tissue(ctx, crosswalk(where, "mesh", tissues, "mesh_id", term="uber_id"), "term"),
        _johnson_common(own),
    )


@source("Johnson_2023_rnaseq", of="Johnson_2023")
def johnson_rnaseq(ctx: Context, raw: DataFrame, diseases: DataFrame, tissues: DataFrame, normal_control: DataFrame | None = None) -> DataFrame:
    """raw: run, disease, tissue, sex, age_group. diseases: original_label, mondo_id, mondo_name. tissues: original_label, uber_id.

    The control's six-zero id stays as it is.
    """
    own = raw.withColumnRenamed("run", "accession")
    sick = inside(crosswalk(own, "disease", diseases, "original_label", term="mondo_id", name="mondo_name"), "term", ctx.diseases, (SIX_ZEROS,))
    where = crosswalk(own, "tissue", tissues, "original_label", term="uber_id")
    return together(claims(sick, "accession", "disease", F.col("term"), F.col("name")), _johnson_tissue(ctx, where, "term").where("term_name is not null"), _johnson_common(own))


@source("Curated_GSM")
def curated_gsm(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: GSM, ID, ID_name, task. Diseases that can't be mapped are dropped."""
    where = inside(raw.where("task = 'tissue'"), "ID", ctx.tissues)
    sick = inside(mapped_disease(raw.where("task = 'disease'"), F.col("ID"), ctx.to_disease["DOID"]), "mondo", ctx.diseases)
    sick = named(sick, "mondo", ctx.names)
    return together(claims(where, "GSM", "tissue", F.col("ID"), F.col("ID_name")), claims(sick, "GSM", "disease", F.col("mondo"), F.coalesce("name", F.lit(NA))))


@source("Sirota_2011")
def sirota(ctx: Context, raw: DataFrame, diseases: DataFrame, tissues: DataFrame) -> DataFrame:
    """raw: DISEASE CUI, TISSUE CUI, CONTROL GSM, DISEASE GSM (numbers joined by commas). diseases: CUI, mapped_mondo_id, mondo_name.
    tissues: TISSUE_CUI, mapped_uber_id, uberon_name."""
    side = lambda column, disease: exploded(raw.select(F.col(f"`{column}`").alias("n"), F.col("`TISSUE CUI`").alias("tissue"), disease.alias("disease")), "n", ",")
    own = together(side("DISEASE GSM", F.col("`DISEASE CUI`")), side("CONTROL GSM", F.lit("control"))).select(F.concat(F.lit("GSM"), "n").alias("accession"), "tissue", "disease").distinct()
    sick = crosswalk(own.where("disease <> 'control'"), "disease", diseases, "CUI", term="mapped_mondo_id", name="mondo_name").select("accession", "term", "name").distinct()
    controls = own.where("disease = 'control'").select("accession").distinct()
    where = inside(crosswalk(own, "tissue", tissues, "TISSUE_CUI", term="mapped_uber_id", name="uberon_name"), "term", ctx.tissues).select("accession", "term", "name").distinct()
    return together(
        claims(inside(sick, "term", ctx.diseases), "accession", "disease", F.col("term"), F.col("name")),
        claims(controls, "accession", "disease", F.lit(CONTROL_ID), F.lit(CONTROL_NAME)),
        claims(where, "accession", "tissue", F.col("term"), F.col("name")),
    )


@source("URSA")
def ursa(ctx: Context, raw: DataFrame) -> DataFrame:
    """raw: accession, study_id, term_id, without a header."""
    own = named(raw, "term_id", ctx.names).where("name is not null")
    return claims(inside(own, "term_id", ctx.tissues), "accession", "tissue", F.col("term_id"), F.col("name"))


# Words of a description that tell the sex, and the layouts of an age with the unit they imply.
FEMALE_WORDS = ("placenta", "cervix", "trimester", "myometrium", "hysterectomy", "ovarian", "ovary", "vagina", "vulva")
MALE_WORDS = ("prostate",)
AGE_LAYOUTS = ((r"\bage: (.*?)\|", ""), (r"age \(y\): (.*?)\|", " years"), (r"block age \(at extraction in years\): (.*?)\|", " years"), (r"age \(months\): (.*?)\|", " months"), (r"age_years: (.*?)\|", " years"), (r"age\.at\.surgery: (.*?)\|", ""))
SEX_LAYOUTS = (r"sex:\s*(.*?)\|", r"sex=\s*(.*?)\|", r"gender:\s*(female|male|f\b|m\b)")


def described_age(description: Column) -> Column:
    """Years from a description: the first layout that occurs counts; months are divided by 12."""
    text = F.concat(F.lower(description), F.lit("|"))
    raw = first_case([(text.rlike(pattern.replace("(.*?)\\|", "")), F.concat(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(unit))) for pattern, unit in AGE_LAYOUTS])
    number = extract(raw, r"(\d+\.?\d*)").try_cast("double")
    return F.when(raw.contains("months"), months_to_years(number)).otherwise(number)


def described_sex(description: Column) -> Column:
    """male or female from a description: by layout, else by a word."""
    text = F.concat(F.lower(description), F.lit("|"))
    layouts = [(text.rlike(probe), F.regexp_extract(text, pattern, 1)) for pattern, probe in zip(SEX_LAYOUTS, ("sex:", "sex=", SEX_LAYOUTS[2]), strict=True)]
    female = any_of(text.contains("|female|"), *(text.contains(w) for w in FEMALE_WORDS))
    male = any_of(text.contains("|male|"), *(text.contains(w) for w in MALE_WORDS))
    return first_case([*layouts, (female, F.lit("female")), (male, F.lit("male"))])


@source("URSA_HD")
def ursa_hd(ctx: Context, raw: DataFrame, series_tissues: DataFrame, raw_tissues: DataFrame) -> DataFrame:
    """raw: GSMID, UID, GSEID, GEO Sample Description. series_tissues: GSE, tissue_name, UBERON_ID. raw_tissues: raw_tissue,
    tissue_uberon, uberon_id, for the series GSE3526, whose samples name the tissue in their second field."""
    own = raw.select(F.col("GSMID").alias("accession"), F.col("UID").alias("uid"), F.col("GSEID").alias("gse"), F.col("`GEO Sample Description`").alias("description"))
    sick = exploded(own, "uid")
    sick = mapped_disease(sick, F.concat(F.lit("MESH:"), "uid"), ctx.to_disease["MESH"])
    sick = named(inside(sick, "mondo", ctx.diseases, (CONTROL_ID,)), "mondo", ctx.names)
    disease_name = F.when(F.col("mondo") == CONTROL_ID, CONTROL_NAME).otherwise(F.coalesce("name", F.lit(NA)))
    each = own.select("accession", "gse", "description", F.posexplode(split_multi("gse")).alias("pos", "one"))
    each = crosswalk(each, "one", series_tissues, "GSE", term="UBERON_ID", name="tissue_name")
    by_series = each.groupBy("accession").agg(F.min(F.when(F.col("term").isNotNull(), F.struct("pos", "term", "name"))).alias("t"), F.min("gse").alias("gse"), F.min("description").alias("description"))
    by_series = by_series.withColumn("tissue", F.when(F.col("t").isNull() & F.col("gse").contains("GSE3526"), F.trim(get(split_multi("description"), 1))))
    by_series = crosswalk(by_series, "tissue", raw_tissues, "raw_tissue", other="uberon_id", other_name="tissue_uberon")
    where = by_series.select("accession", F.coalesce("t.term", "other").alias("term"), F.coalesce("t.name", "other_name").alias("name"))
    return together(
        claims(sick, "accession", "disease", F.col("mondo"), disease_name),
        claims(inside(where, "term", ctx.tissues), "accession", "tissue", F.col("term"), F.col("name")),
        ages(own, "accession", described_age(F.col("description"))),
        sexes(own, "accession", described_sex(F.col("description"))).withColumn("term_name", F.col("term_id")),
    )
