"""Types, the policy of each entity type, and the relation vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SPAN = T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])
NP_CLASS = T.StructType([T.StructField("Np_class", T.ArrayType(T.StringType())), T.StructField("Np_superclass", T.ArrayType(T.StringType()))])
CLASSYFIRE = T.StructType([T.StructField(x, T.StringType()) for x in ("Kingdom", "Superclass", "Class", "Subclass")])

#: One wide row for any entity; entity_type says which fields apply.
ENTITY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("alt_names", T.ArrayType(T.StringType())),
        T.StructField("ontology_id", T.StringType()),
        T.StructField("normalized_name", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("CID", T.LongType()),
        T.StructField("SMILES", T.StringType()),
        T.StructField("InChIKey", T.StringType()),
        T.StructField("Natural_product_class", NP_CLASS),
        T.StructField("Classyfire", CLASSYFIRE),
        T.StructField("taxonomy_id", T.IntegerType()),
    ]
)
RELATION = T.StructType(
    [
        T.StructField("subject_entity", ENTITY),
        T.StructField("predicate", T.StringType()),
        T.StructField("object_entity", ENTITY),
        T.StructField("category", T.StringType()),
        T.StructField("justification", T.StringType()),
        T.StructField("context", T.StringType()),
    ]
)

# Entity types, what each is linked to, the least score (exclusive), namespace, keys for merging.
ENTITY_POLICY = [
    ("compounds", "chemont", 0.90, None, ["ontology_id", "CID"]),
    ("pathways", "plantcyc_pathways", 0.80, None, ["ontology_id"]),
    ("anatomical_structures", "po", 0.90, None, ["ontology_id"]),
    ("plant_traits", "to", 0.75, None, ["ontology_id"]),
    ("molecular_traits", "go", 0.85, "molecular_function", ["ontology_id"]),
    ("experimental_conditions", "peco", 0.80, None, ["ontology_id"]),
    ("species", None, None, None, ["taxonomy_id"]),
    ("genes", None, None, None, []),
    ("human_traits", None, None, None, []),
]
ENTITY_TYPES = [row[0] for row in ENTITY_POLICY]
DEFAULT_THRESHOLD = 0.9
NO_RELATION = "No_Relationship"

# Section and passage types that are read.
SECTIONS = ["ABSTRACT", "INTRO", "RESULTS", "DISCUSS", "CONCL", "FIG"]
PASSAGE_TYPES = ["ABSTRACT", "PARAGRAPH", "FIG_TITLE_CAPTION", "FIG_CAPTION"]
ANNOTATION_TYPES = {"Chemical": "compounds", "Gene": "genes", "Species": "species"}

# Predicates of each category.  The definitions are our own words.
PREDICATES = {
    "compounds": ["associated_with", "present_in", "correlates_with", "positively_regulated_by", "negatively_regulated_by"],
    "pathways": ["made_via", "degraded_via", "involved_in", "associated_with", "correlates_with", "positively_correlates_with", "negatively_correlates_with"],
    "genes": [
        "made_by", "degraded_by", "correlates_with", "positively_correlates_with", "negatively_correlates_with", "positively_regulated_by",
        "negatively_regulated_by", "secreted_by", "transported_by",
    ],
    "anatomical_structures": ["made_in", "accumulates_in", "present_in"],
    "species": ["made_in", "accumulates_in", "present_in"],
    "experimental_conditions": [
        "made_under", "accumulates_under", "present_under", "associated_with", "involved_in", "positively_regulated_by", "negatively_regulated_by",
        "correlates_with", "positively_correlates_with", "negatively_correlates_with",
    ],
    "molecular_traits": ["affects", "modulates", "involved_in", "associated_with", "correlates_with", "positively_correlates_with", "negatively_correlates_with"],
    "plant_traits": ["affects", "modulates", "involved_in", "associated_with", "correlates_with", "positively_correlates_with", "negatively_correlates_with"],
    "human_traits": ["affects", "modulates"],
}
DEFINITIONS = {
    "made_via": "The compound comes out of this pathway.",
    "degraded_via": "The compound is broken down along this pathway.",
    "involved_in": "The compound has a part in it.",
    "associated_with": "The text ties the two together without saying how.",
    "correlates_with": "The two vary together, in a direction that is not given.",
    "positively_correlates_with": "The two rise and fall together.",
    "negatively_correlates_with": "One rises as the other falls.",
    "made_by": "The gene or its product makes the compound.",
    "degraded_by": "The gene or its product breaks the compound down.",
    "positively_regulated_by": "It raises the compound's amount or activity.",
    "negatively_regulated_by": "It lowers the compound's amount or activity.",
    "secreted_by": "The compound is let out by it.",
    "transported_by": "The compound is moved by it.",
    "made_in": "The compound is made there.",
    "accumulates_in": "The compound gathers there.",
    "present_in": "The compound is found there.",
    "made_under": "The compound is made under this condition.",
    "accumulates_under": "The compound gathers under this condition.",
    "present_under": "The compound is found under this condition.",
    "affects": "The compound has an influence on the trait.",
    "modulates": "The compound tunes the trait up or down.",
}
# Categories that have predicates but no guideline.
NOT_GUIDED = ["human_traits"]
NO_DEFINITION = "No definition available."


def entity_policy(spark: SparkSession) -> DataFrame:
    """The policy as a table, to be broadcast: nine rows."""
    return spark.createDataFrame(ENTITY_POLICY, "entity_type string, ontology string, threshold double, namespace string, key_order array<string>")


def predicate_guidelines(spark: SparkSession) -> DataFrame:
    """category, predicate, definition: a table of fixed size."""
    rows = [(c, p, DEFINITIONS[p]) for c, names in PREDICATES.items() if c not in NOT_GUIDED for p in names]
    return spark.createDataFrame(rows, "category string, predicate string, definition string")
