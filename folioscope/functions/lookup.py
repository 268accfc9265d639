"""Rename and classification rules as constant expressions, so no join is planned for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Retired arXiv archive names and the categories that replaced them.
ARXIV_CATEGORY_RENAMES = {
    "acc-phys": "physics.acc-ph",
    "adap-org": "nlin.AO",
    "alg-geom": "math.AG",
    "ao-sci": "physics.ao-ph",
    "atom-ph": "physics.atom-ph",
    "bayes-an": "physics.data-an",
    "chao-dyn": "nlin.CD",
    "chem-ph": "physics.chem-ph",
    "cmp-lg": "cs.CL",
    "comp-gas": "nlin.CG",
    "dg-ga": "math.DG",
    "funct-an": "math.FA",
    "mtrl-th": "cond-mat.mtrl-sci",
    "patt-sol": "nlin.PS",
    "plasm-ph": "physics.plasm-ph",
    "q-alg": "math.QA",
    "solv-int": "nlin.SI",
    "supr-con": "cond-mat.supr-con",
}

# The key found in a provider address and the provider's name.
OSF_PROVIDERS = {
    "psyarxiv": "PsyArXiv",
    "socarxiv": "SocArXiv",
    "engrxiv": "engrXiv",
    "lawarxiv": "LawArXiv",
    "inarxiv": "INA-Rxiv",
    "eartharxiv": "EarthArXiv",
    "paleorxiv": "PaleorXiv",
    "sportrxiv": "SportRxiv",
    "thesiscommons": "Thesis Commons",
    "lissa": "LIS Scholarship Archive",
    "mindrxiv": "MindRxiv",
    "metaarxiv": "MetaArXiv",
    "marxiv": "MarXiv",
    "agrixiv": "AgriXiv",
    "focusarchive": "FocUS Archive",
    "nutrixiv": "NutriXiv",
    "arabixiv": "Arabixiv",
    "ecsarxiv": "ECSarXiv",
    "africarxiv": "AfricArXiv",
    "ecoevorxiv": "EcoEvoRxiv",
    "frenxiv": "Frenxiv",
    "mediarxiv": "MediArXiv",
    "bodoarxiv": "BodoArXiv",
    "edarxiv": "EdArXiv",
    "indiarxiv": "IndiaRxiv",
    "biohackrxiv": "BioHackrXiv",
}
# Fixed value: the address that stands for the archive itself.
OSF_PROVIDER_PREFIX = "https://api.osf.io/v2/providers/preprints/osf/"


def rename(value: Column, renames: dict[str, str]) -> Column:
    """Exact rename; a value without a rule passes through."""
    table = F.create_map(*[F.lit(x) for pair in renames.items() for x in pair])
    return F.coalesce(table[value], value)


def convert_categories(categories: Column) -> Column:
    return F.transform(categories, lambda c: rename(c, ARXIV_CATEGORY_RENAMES))


def last_rule(value: Column, rules: dict[str, str]) -> Column:
    """Value of the last rule whose key occurs in ``value``, null when none does."""
    table = F.array(
        *[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in rules.items()]
    )
    return F.try_element_at(
        F.filter(table, lambda rule: F.contains(value, rule["k"])), F.lit(-1)
    )["v"]


def provider(url: Column) -> Column:
    return F.coalesce(
        last_rule(url, OSF_PROVIDERS),
        F.when(F.startswith(url, F.lit(OSF_PROVIDER_PREFIX)), F.lit("OSF")),
        F.lit("Unknown"),
    )
