"""Prompts as column expressions, in our own words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFINITIONS, ENTITY_TYPES, NO_RELATION, PREDICATES

_ASK = "List every entity that the passage names, as JSON with a list for each of: " + ", ".join(ENTITY_TYPES) + '. Each entry is {"name": the words of the passage}. Leave out what the passage does not name.'
EXTRACTION_SQL = "'" + _ASK.replace("'", "''") + "' || chr(10) || 'Passage: ' || "


def extraction(text: Column) -> Column:
    """Asks for the entities of a passage."""
    return F.concat(F.lit(_ASK), F.lit("\nPassage: "), text)


def _also(names: Column) -> Column:
    listed = F.array_join(F.coalesce(names, F.array().cast("array<string>")), ", ")
    return F.when(listed != "", F.concat(F.lit(" (also: "), listed, F.lit(")"))).otherwise("")


def allowed(category: Column) -> Column:
    """A line for each predicate of a category, with its meaning, the one for none last; of other categories that alone."""
    none = f"- {NO_RELATION}: the text states none"
    blocks = [x for c, names in PREDICATES.items() for x in (F.lit(c), F.lit("\n".join([*(f"- {p}: {DEFINITIONS[p]}" for p in names), none])))]
    return F.coalesce(F.try_element_at(F.create_map(*blocks), category), F.lit(none))


def relation(subject: Column, subject_names: Column, obj: Column, object_names: Column, category: Column, context: Column, guided: bool = False) -> Column:
    """Asks for the relation of a pair; guided: by one of the predicates that its category allows, else in free words."""
    how = F.concat(F.lit("the predicate is one of these:\n"), allowed(category), F.lit("\n")) if guided else F.lit(f"the predicate is a short verb phrase, or {NO_RELATION} if the text states none.\n")
    return F.concat(
        F.lit("How does the compound "), subject, _also(subject_names), F.lit(" relate to "), obj, _also(object_names), F.lit(", one of the "), category,
        F.lit('? Answer with JSON {"predicate", "justification"}; '), how, F.lit("Text: "), context,
    )


def evaluation(subject: Column, predicate: Column, obj: Column, definition: Column, justification: Column, context: Column) -> Column:
    """Asks whether a relation holds in its context."""
    return F.concat(
        F.lit('Does the text support this statement? Answer with JSON {"decision": "yes" or "no"}.\nStatement: '), subject, F.lit(" "), predicate, F.lit(" "), obj,
        F.lit("\nMeaning: "), definition, F.lit("\nGiven reason: "), justification, F.lit("\nText: "), context,
    )
