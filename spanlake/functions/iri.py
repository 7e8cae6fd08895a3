"""Ontology identifiers: structural checks and an optional classifier by registry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Words that stand for no identifier, and the structure of any identifier.
NO_IRI = ["n/a", "none", "null", "unmapped"]
GENERIC_IRI = r"^(https?://[^\s]+|urn:[A-Za-z0-9][A-Za-z0-9:._\-]+|[A-Za-z][A-Za-z0-9_]*:[A-Za-z0-9_\-]+)$"

#: Identifiers of the common OBO scheme, as addresses and in short.
OBO, SHORT = r"^https?://purl\.obolibrary\.org/obo/{}_[0-9]+(?:[/#?].*)?$", r"^{}:[0-9A-Za-z\-_]+$"
#: The registered ontologies in the order in which they are tried; by prefix where they follow that scheme, else with patterns.
REGISTRY = {
    "uberon": "UBERON",
    "cl": "CL",
    "pcl": "PCL",
    "fma": "FMA",
    "nifstd": [r"^https?://uri\.neuinfo\.org/nif/nifstd/[A-Za-z0-9_]+$"],
    "go": "GO",
    "obi": "OBI",
    "efo": [r"^https?://www\.ebi\.ac\.uk/efo/EFO_[0-9]+$", r"^EFO:[0-9]+$"],
    "mondo": "MONDO",
    "doid": "DOID",
    "hp": "HP",
    "mp": "MP",
    "chebi": "CHEBI",
    "dron": "DRON",
    "bto": "BTO",
    "pr": "PR",
    "ncbitaxon": "NCBITaxon",
    "hgnc": [r"^https?://identifiers\.org/hgnc/[0-9]+$", r"^HGNC:[0-9]+$"],
    "ncbigene": [r"^https?://www\.ncbi\.nlm\.nih\.gov/gene/[0-9]+$", r"^NCBIGene:[0-9]+$"],
    "mgi": [r"^MGI:[0-9]+$", r"^https?://www\.informatics\.jax\.org/marker/MGI:[0-9]+$"],
    "uniprot": [r"^https?://(?:www\.)?uniprot\.org/uniprot(?:kb)?/[A-Z0-9]{6,10}$", r"^UniProtKB:[A-Z0-9]{6,10}$"],
    "snomedct": [r"^https?://purl\.bioontology\.org/ontology/SNOMEDCT/[A-Za-z0-9_\-]+$", r"^SNOMEDCT:[A-Za-z0-9_\-]+$"],
}
#: Shapes of identifiers of ontologies beyond the registry.
PLAUSIBLE = [
    r"^https?://purl\.obolibrary\.org/obo/[A-Za-z]+_[0-9]+(?:[/#?].*)?$",
    r"^https?://purl\.bioontology\.org/ontology/[A-Za-z0-9_\-]+/[A-Za-z0-9_\-]+$",
    r"^https?://identifiers\.org/[A-Za-z0-9._]+(?:/[A-Za-z0-9._:-]+)?$",
    r"^https?://www\.ebi\.ac\.uk/[A-Za-z0-9/_-]+/[A-Za-z0-9_]+_[0-9]+$",
    r"^https?://www\.semanticweb\.org/.+#[A-Za-z0-9_]+$",
    r"^https?://[A-Za-z0-9./_-]+/[A-Za-z0-9._-]+_[0-9]+$",
]


def registry() -> dict[str, list[str]]:
    """Patterns of each of the registered ontologies."""
    return {name: [x.format(known) for x in (OBO, SHORT)] if isinstance(known, str) else known for name, known in REGISTRY.items()}


def well_formed(c: Column) -> Column:
    """Whether an identifier is structurally sound; null is not."""
    v = strip(c)
    return F.coalesce((v != "") & ~F.lower(v).isin(NO_IRI) & v.rlike(GENERIC_IRI), F.lit(False))


def known_ontology(c: Column) -> Column:
    """Name of the first registered ontology whose patterns match; null if none does."""
    v, out = strip(c), F.lit(None).cast("string")
    for name, patterns in reversed(registry().items()):
        out = F.when(v.rlike("|".join(f"(?:{p})" for p in patterns)), name).otherwise(out)
    return out


def plausible(c: Column) -> Column:
    """Whether an identifier has the shape of a real ontology's, registered or not."""
    return F.coalesce(strip(c).rlike("|".join(f"(?:{p})" for p in PLAUSIBLE)), F.lit(False))
