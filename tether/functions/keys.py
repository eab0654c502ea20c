"""Knowledge-base ids in their three spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabulary of the graph.
KB_NAMESPACE = "http://rdf.freebase.com/ns/"
SAME_AS = "http://www.w3.org/2002/07/owl#sameAs"
ABSTRACT = "http://dbpedia.org/ontology/abstract"


def kb_key(kb_id: Column) -> Column:
    """``/m/0abc`` to ``m.0abc``: the first three characters give way to ``m.``."""
    return F.concat(F.lit("m."), F.substr(kb_id, F.lit(4)))


def kb_iri(kb_id: Column, namespace: str = KB_NAMESPACE) -> Column:
    """``/m/0abc`` to its graph IRI."""
    return F.concat(F.lit(namespace), kb_key(kb_id))
