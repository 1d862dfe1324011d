"""Schemas and fixed values of the claim model.

Canonical data is long and sparse: ``claims`` (who says what about an entry), ``entries`` (one row for an entry),
``cells`` (entry, term) and ``closure`` (ancestor, descendant). Wide frames exist only at export.
"""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: What each source is normalised to.
PROCESSED = _strings("accession", "attribute", "term_id", "term_name", "ecode")
#: Claims of all sources.
CLAIMS = _strings("entry", "attribute", "source", "term_id", "term_name", "ecode")
ENTRIES = _strings("entry", "sample", "series", "platform", "srx", "srs", "srp", "organism")
EDGES = _strings("parent", "child")
CLOSURE = _strings("ancestor", "descendant")
CELLS = _strings("entry", "term")
SYNONYMS = _strings("term_id", "synonym", "scope")
TERMS = _strings("term_id", "name", "ontology", "type")

# Delimiter, absent values, control term, evidence codes.
DELIMITER = "|"
NA = "NA"
NA_QUERY = ("na", "", "NA", "not annotated")
NA_BUILD = (*NA_QUERY, "none")
CONTROL_ID, CONTROL_NAME = "MONDO:0000000", "control"
EXPERT, CROWD = "expert-curated", "crowd-sourced"
ECODES = {"expert": (EXPERT,), "crowd": (CROWD,), "any": (EXPERT, CROWD)}
ATTRIBUTES = ("tissue", "disease", "sex", "age")
LEVELS = ("sample", "series")
TECHNOLOGIES = ("rnaseq", "microarray")
MODES = ("annotate", "label", "direct")
# Species that can be asked for, and organisms that a build accepts.
SPECIES = {"human": "homo sapiens", "mouse": "mus musculus", "zebrafish": "danio rerio", "rat": "rattus norvegicus"}
ORGANISMS = ("homo sapiens", "mus musculus", "caenorhabditis elegans", "rattus norvegicus", "danio rerio", "drosophila melanogaster")
SEXES = {"male": "M", "female": "F"}
# Closed age intervals in years; the first that holds an age counts.
AGE_GROUPS = (("fetus", -1, 0), ("infant", 0, 2), ("child", 2, 10), ("adolescent", 10, 20), ("adult", 20, 50), ("older_adult", 50, 80), ("elderly_adult", 80, 150))
# Licence category of each public source. Others are named by a registry that the user passes.
LICENCES = {
    "ALE": "permissive", "BGee": "permissive", "Cello": "permissive", "CREEDS": "permissive", "DiSignAtlas": "nc", "Gemma": "nc",
    "Golightly_2018": "permissive", "Gu_2023": "permissive", "Johnson_2023": "permissive",
    "Sirota_2011": "nc", "URSA": "nc", "URSA_HD": "nc",
}
# Kind of term by prefix of its id.
TERM_TYPES = {"MONDO": "disease", "UBERON": "tissue", "CL": "celltype"}
# Weights of name and synonym scopes in search; no scope means RELATED.
NAME_WEIGHT = 10
SCOPE_WEIGHTS = {"EXACT": 8, "NARROW": 7, "BROAD": 3, "RELATED": 1}
#: Orders in which a hit's synonyms are listed: by the search, and by the search table function.
SCOPE_ORDER_SEARCH = ("EXACT", "BROAD", "NARROW", "RELATED")
SCOPE_ORDER_TABLE = ("EXACT", "NARROW", "BROAD", "RELATED")
SAMPLE_METADATA = ("sample", "series", "platform", "description", "srx", "srs", "srp")
SERIES_METADATA = ("series", "platform", "description", "srp")
#: Label values.
POSITIVE, UNKNOWN, NEGATIVE, CONTROL = 1, 0, -1, 2
