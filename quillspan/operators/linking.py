"""Entity linking: nearest ontology term, compound and species tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_ascii
from .nearest import nearest_terms

BINOMIAL = "^[A-Z][a-z]+ [a-z]+$"
def surface_forms(terms: DataFrame, name: Column, synonyms: Column) -> DataFrame:
    """terms with a row for each distinct surface form: the name and its synonyms."""
    forms = F.filter(F.array_distinct(F.concat(F.array(F.trim(name)), synonyms)), lambda x: x.isNotNull() & (x != ""))
    return terms.withColumn("surface", F.explode(forms))


def first_by(df: DataFrame, key: str | list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in this order: the meaning of INSERT OR IGNORE and of LIMIT 1."""
    keys = [key] if isinstance(key, str) else key
    names = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*names), by).alias("_first"))
    return best.select(*keys, *[F.col(f"_first.{n}").alias(n) for n in names])


def link_compounds(compounds: DataFrame, synonyms: DataFrame, smiles: DataFrame, inchikeys: DataFrame) -> DataFrame:
    """compounds (name, ontology_id, ...) with cid, smiles and inchikey; those with an ontology_id are left alone.

    synonyms: row_idx, cid, synonym.  Names are compared without ASCII case; of equal synonyms the first row counts.
    """
    index = first_by(synonyms.select(fold_ascii(F.col("synonym")).alias("folded"), "row_idx", "cid"), "folded", "row_idx").select("folded", "cid")
    keyed = compounds.withColumn("folded", F.when(F.col("ontology_id").isNull(), fold_ascii(F.col("name"))))
    return left_join(left_join(left_join(keyed, index, "folded").drop("folded"), smiles, "cid"), inchikeys, "cid")


def link_species(species: DataFrame, names: DataFrame, nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """species (name, ...) with taxonomy_id: the tax id of an equal name of rank species, by way of one redirect.

    names: row_idx, tax_id, name, name_class.  A scientific name goes before other classes, then the first row;
    names are compared with case, ranks without.
    """
    ranked = names.join(nodes.where(fold_ascii(F.col("rank")) == "species").select("tax_id"), "tax_id")
    ranked = ranked.withColumn("turn", F.when(F.col("name_class") == "scientific name", 0).otherwise(1))
    best = first_by(ranked.select("name", "turn", "row_idx", "tax_id"), "name", "turn", "row_idx").select("name", "tax_id")
    found = species.join(best, "name", "left").join(merged.select(F.col("old_tax_id").alias("tax_id"), "new_tax_id"), "tax_id", "left")
    return found.withColumn("taxonomy_id", F.coalesce("new_tax_id", "tax_id")).drop("tax_id", "new_tax_id")


def short_binomial(name: Column) -> Column:
    """The lower-case "g. epithet" of a full binomial, null for other names."""
    return F.when(name.rlike(BINOMIAL), F.lower(F.concat(F.substring(name, 1, 1), F.lit(". "), F.get(F.split(name, " "), F.lit(1)))))


def expand_binomials(species: DataFrame) -> DataFrame:
    """species (doc_id, name, ...) with lookup_name: the full binomial of the same document for a shortened one, the
    least of several, else the name."""
    full = species.where(short_binomial(F.col("name")).isNotNull()).groupBy("doc_id", short_binomial(F.col("name")).alias("_short")).agg(F.min("name").alias("_full"))
    joined = species.withColumn("_short", F.lower("name")).join(full, ["doc_id", "_short"], "left")
    return joined.withColumn("lookup_name", F.coalesce("_full", "name")).drop("_short", "_full")


def left_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows.join(table, key, "left") whose rows without a key are dealt out instead of meeting in one task."""
    plain = [f.name for f in rows.schema if f.name != key and isinstance(f.dataType, T.AtomicType)]
    deal = F.pmod(F.xxhash64(*plain), F.lit(4096)) + 1 if plain else F.lit(1)
    dealt = rows.withColumn("_deal", F.when(F.col(key).isNull(), deal).otherwise(0))
    return dealt.join(table.withColumn("_deal", F.when(F.col(key).isNull(), -1).otherwise(0)), [key, "_deal"], "left").drop("_deal")


def attach_once(entities: DataFrame, classes: DataFrame, key: str, *order: str, deals: int = 256) -> DataFrame:
    """entities with the columns of classes joined by key, on the first entity of each key alone; null keys have none.

    The first of a key is found among the firsts of its ``deals`` shares, so a key that most entities have is no single
    task; rows without a key are dealt out as well.
    """
    share = F.pmod(F.xxhash64(*order), F.lit(deals))
    own = F.row_number().over(Window.partitionBy(key, "_share").orderBy(*order)) == 1
    turns = entities.withColumn("_share", share).withColumn("_one", F.col(key).isNotNull() & own)
    last = F.when(F.col("_one"), -1).otherwise(F.col("_share"))
    marked = turns.withColumn("_share", last).withColumn("_first", F.col("_one") & (F.row_number().over(Window.partitionBy(key, "_share").orderBy(*order)) == 1))
    joined = left_join(marked, classes, key)
    new = [c for c in classes.columns if c != key]
    return joined.select(*[c for c in entities.columns], *[F.when(F.col("_first"), F.col(c)).alias(c) for c in new])


def classify_compounds(entities: DataFrame, classifier, *order: str) -> DataFrame:
    """entities with Classyfire: what the provider says of an InChIKey, on its first compound alone.

    Asked are compounds that have SMILES and InChIKey, each key once; classifier takes InChIKey and SMILES and gives
    InChIKey, Kingdom, Superclass, Class and Subclass.
    """
    ready = entities.where("entity_type = 'compounds' AND SMILES IS NOT NULL AND InChIKey IS NOT NULL")
    asked = ready.groupBy("InChIKey").agg(F.min("SMILES").alias("SMILES"))
    classes = classifier(asked).select("InChIKey", F.struct("Kingdom", "Superclass", "Class", "Subclass").alias("Classyfire"))
    return attach_once(entities, classes, "InChIKey", *order)


def natural_products(entities: DataFrame, classifier) -> DataFrame:
    """entities with Natural_product_class of compounds without an ontology_id: classifier takes distinct SMILES and
    gives SMILES, Np_class and Np_superclass (arrays)."""
    asked = F.when((F.col("entity_type") == "compounds") & F.col("ontology_id").isNull(), F.col("SMILES"))
    keyed = entities.withColumn("_smiles", asked)
    classes = classifier(keyed.select(F.col("_smiles").alias("SMILES")).where("SMILES IS NOT NULL").distinct())
    classes = classes.select(F.col("SMILES").alias("_smiles"), F.struct("Np_class", "Np_superclass").alias("Natural_product_class"))
    return left_join(keyed, classes, "_smiles").drop("_smiles")
