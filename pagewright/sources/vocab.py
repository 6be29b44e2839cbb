"""Vocabulary sources: seed lists (S10), built-in term patterns (S11),
vocabulary-table projections (S9), acronym typing (E2) and the merged
gazetteer (U3, X3).

Vocabularies are dimension tables: thousands of rows, not billions.  The
gazetteer is joined to text by broadcast behind a row-count check
(:func:`pagewright.operators.partitioning.size_checked_broadcast`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators.tokens import SPARK_TOKEN_RE, normalize_name, token_array

# ---------------------------------------------------------------------------
# Seed vocabularies (names and categories as the reference
# lists them; descriptions are not needed for matching and are left empty).
# ---------------------------------------------------------------------------
SEED_SYMPTOMS = [
    ("Memory loss", "Cognitive"), ("Cognitive decline", "Cognitive"),
    ("Executive dysfunction", "Cognitive"), ("Aphasia", "Language"), ("Anomia", "Language"),
    ("Apraxia", "Motor"), ("Tremor", "Motor"), ("Bradykinesia", "Motor"), ("Rigidity", "Motor"),
    ("Postural instability", "Motor"), ("Chorea", "Motor"), ("Dystonia", "Motor"),
    ("Ataxia", "Motor"), ("Dysphagia", "Bulbar"), ("Dysarthria", "Bulbar"),
    ("Visual hallucinations", "Psychiatric"), ("Depression", "Psychiatric"),
    ("Anxiety", "Psychiatric"), ("Apathy", "Psychiatric"), ("Disinhibition", "Psychiatric"),
    ("Sleep disturbances", "Sleep"), ("REM sleep behavior disorder", "Sleep"),
    ("Olfactory dysfunction", "Sensory"), ("Visuospatial deficits", "Cognitive"),
]
SEED_PROTEINS = [
    ("Tau", "Microtubule-associated", True), ("p-tau", "Microtubule-associated", True),
    ("Amyloid beta", "Amyloid", True), ("Aβ", "Amyloid", True),
    ("Alpha-synuclein", "Synuclein", True), ("α-synuclein", "Synuclein", True),
    ("TDP-43", "RNA-binding", True), ("Neurofilament light chain", "Cytoskeletal", True),
    ("NfL", "Cytoskeletal", True), ("Ubiquitin", "Protein degradation", False),
    ("Prion protein", "Prion", True), ("PrP", "Prion", True),
    ("Huntingtin", "Polyglutamine", False), ("SOD1", "Antioxidant", False),
    ("APOE", "Lipoprotein", True), ("APOE4", "Lipoprotein", True),
]
SEED_BRAIN_REGIONS = [
    ("Hippocampus", "Limbic system"), ("Amygdala", "Limbic system"),
    ("Frontal lobe", "Cerebral cortex"), ("Prefrontal cortex", "Frontal lobe"),
    ("Temporal lobe", "Cerebral cortex"), ("Parietal lobe", "Cerebral cortex"),
    ("Occipital lobe", "Cerebral cortex"), ("Entorhinal cortex", "Temporal lobe"),
    ("Basal ganglia", "Subcortical"), ("Substantia nigra", "Midbrain"),
    ("Thalamus", "Diencephalon"), ("Hypothalamus", "Diencephalon"),
    ("Cerebellum", "Hindbrain"), ("Brainstem", "Hindbrain"), ("Locus coeruleus", "Brainstem"),
    ("Nucleus basalis of Meynert", "Basal forebrain"), ("Cingulate cortex", "Limbic system"),
    ("Corpus callosum", "Cerebral cortex"),
]
SEED_ACRONYMS = [
    ("AD", "Alzheimer's disease", "Disease"), ("PD", "Parkinson's disease", "Disease"),
    ("HD", "Huntington's disease", "Disease"), ("ALS", "Amyotrophic Lateral Sclerosis", "Disease"),
    ("FTD", "Frontotemporal Dementia", "Disease"), ("LBD", "Lewy Body Dementia", "Disease"),
    ("MCI", "Mild Cognitive Impairment", "Condition"), ("CSF", "Cerebrospinal Fluid", "Biological"),
    ("BBB", "Blood-Brain Barrier", "Biological"), ("MRI", "Magnetic Resonance Imaging", "Diagnostic"),
    ("PET", "Positron Emission Tomography", "Diagnostic"), ("EEG", "Electroencephalography", "Diagnostic"),
    ("MMSE", "Mini-Mental State Examination", "Assessment"), ("APOE", "Apolipoprotein E", "Genetic"),
    ("NFT", "Neurofibrillary Tangles", "Pathology"), ("Aβ", "Amyloid Beta", "Protein"),
    ("NfL", "Neurofilament Light Chain", "Biomarker"), ("WM", "Working Memory", "Cognitive"),
    ("EM", "Episodic Memory", "Cognitive"), ("CNS", "Central Nervous System", "Anatomical"),
]
# Built-in term patterns (label, phrase); phrases are tokenized
# by the same tokenizer as the text.
BUILTIN_PATTERNS = [
    ("DISEASE", "alzheimer's disease"), ("DISEASE", "alzheimer disease"), ("DISEASE", "ad"),
    ("BIOMARKER", "biomarker"), ("BIOMARKER", "core biomarker"),
    ("SYMPTOM", "symptom"), ("SYMPTOM", "symptoms"), ("SYNDROME", "syndrome"),
    ("ETIOLOGY", "etiology"), ("NEUROPATHOLOGIC", "neuropathologic"),
    ("NEUROPATHOLOGIC", "neuropathologic change"), ("NEUROPATHOLOGIC", "neuropathologic finding"),
    ("PROTEIN", "tau"), ("PROTEIN", "p-tau"), ("PROTEIN", "phosphorylated tau"),
    ("PROTEIN", "amyloid"), ("PROTEIN", "amyloid beta"), ("PROTEIN", "aβ"),
    ("PROTEIN", "alpha-synuclein"), ("PROTEIN", "α-synuclein"), ("PROTEIN", "tdp-43"),
    ("BRAIN_REGION", "hippocampus"), ("BRAIN_REGION", "hippocampal"),
    ("BRAIN_REGION", "frontal lobe"), ("BRAIN_REGION", "temporal lobe"),
    ("BRAIN_REGION", "parietal lobe"), ("BRAIN_REGION", "occipital lobe"),
    ("BRAIN_REGION", "amygdala"), ("BRAIN_REGION", "cerebellum"), ("BRAIN_REGION", "basal ganglia"),
    ("BRAIN_REGION", "thalamus"), ("BRAIN_REGION", "hypothalamus"), ("BRAIN_REGION", "brainstem"),
    ("BRAIN_REGION", "cortex"), ("BRAIN_REGION", "prefrontal cortex"),
    ("BRAIN_REGION", "entorhinal cortex"),
    ("COGNITIVE_PROCESS", "memory"), ("COGNITIVE_PROCESS", "working memory"),
    ("COGNITIVE_PROCESS", "episodic memory"), ("COGNITIVE_PROCESS", "semantic memory"),
    ("COGNITIVE_PROCESS", "attention"), ("COGNITIVE_PROCESS", "executive function"),
    ("COGNITIVE_PROCESS", "language"), ("COGNITIVE_PROCESS", "visuospatial"),
    ("COGNITIVE_PROCESS", "processing speed"),
]
# Corrected mode: plural forms the article text uses (the reference patterns are
# singular only, so "biomarkers" would never match).
PLURAL_PATTERNS = [
    ("BIOMARKER", "biomarkers"), ("BIOMARKER", "core biomarkers"),
    ("NEUROPATHOLOGIC", "neuropathologic changes"), ("NEUROPATHOLOGIC", "neuropathologic findings"),
]
# Acronym typing by substrings of the lower-cased full form,
# first rule that hits wins.
ACRONYM_TYPE_RULES = [
    ("DISEASE", ["disease", "disorder", "syndrome"]),
    ("SYMPTOM", ["symptom", "sign", "deficit"]),
    ("PROTEIN", ["protein", "peptide", "enzyme"]),
    ("BRAIN_REGION", ["cortex", "lobe", "brain", "nucleus"]),
]
ACRONYM_DEFAULT_TYPE = "ACRONYM"
# Priority when one span matches several labels: lower wins.
SOURCE_PRIORITY = {"builtin": 0, "diseases": 1, "symptoms": 2, "proteins": 3,
                   "brain_regions": 4, "acronyms": 5, "extra": 6}

GAZETTEER_COLUMNS = ["label", "name", "key", "first", "n_tokens", "source", "priority", "exact", "ekey"]


def acronym_type(full_form: Column) -> Column:
    """Label of an acronym from words in its full form."""
    low = F.lower(full_form)
    expr = F.lit(ACRONYM_DEFAULT_TYPE)
    for label, words in reversed(ACRONYM_TYPE_RULES):
        hit = None
        for w in words:
            c = F.instr(low, w) > 0
            hit = c if hit is None else (hit | c)
        expr = F.when(hit, F.lit(label)).otherwise(expr)
    return expr


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The four seed vocabularies as small DataFrames."""
    return {
        "symptoms": spark.createDataFrame(
            [(i + 1, n, "", c) for i, (n, c) in enumerate(SEED_SYMPTOMS)],
            "symptom_id long, name string, definition string, category string"),
        "proteins": spark.createDataFrame(
            [(i + 1, n, "", c, b) for i, (n, c, b) in enumerate(SEED_PROTEINS)],
            "protein_id long, name string, description string, category string, is_biomarker boolean"),
        "brain_regions": spark.createDataFrame(
            [(i + 1, n, "", p) for i, (n, p) in enumerate(SEED_BRAIN_REGIONS)],
            "region_id long, name string, description string, parent_region string"),
        "acronyms": spark.createDataFrame(
            [(i + 1, a, f, c) for i, (a, f, c) in enumerate(SEED_ACRONYMS)],
            "acronym_id long, acronym string, full_form string, category string"),
    }


def builtin_patterns(spark: SparkSession, plurals: bool = True) -> DataFrame:
    rows = BUILTIN_PATTERNS + (PLURAL_PATTERNS if plurals else [])
    return spark.createDataFrame(rows, "label string, name string")


def _entries(df: DataFrame, label: Column, name_col: str, source: str) -> DataFrame:
    return df.select(label.alias("label"), F.col(name_col).alias("name"),
                     F.lit(source).alias("source"))


def vocabulary_entries(spark: SparkSession, tables: dict[str, DataFrame] | None = None,
                       diseases: DataFrame | None = None, extra: DataFrame | None = None) -> DataFrame:
    """S9 + U3: (label, name, source) from every vocabulary, in priority order.

    ``tables`` maps symptoms / proteins / brain_regions / acronyms to their
    tables (seeds by default); ``diseases`` is the loaded disorder table;
    ``extra`` (label, name) is a caller-supplied term list (X3).
    """
    tables = tables or seed_tables(spark)
    parts = [builtin_patterns(spark).select("label", "name", F.lit("builtin").alias("source"))]
    if diseases is not None:
        parts.append(_entries(diseases, F.lit("DISEASE"), "name", "diseases"))
    parts.append(_entries(tables["symptoms"], F.lit("SYMPTOM"), "name", "symptoms"))
    parts.append(_entries(tables["proteins"], F.lit("PROTEIN"), "name", "proteins"))
    parts.append(_entries(tables["brain_regions"], F.lit("BRAIN_REGION"), "name", "brain_regions"))
    acr = tables["acronyms"].where(F.col("full_form").isNotNull() & (F.col("full_form") != ""))
    parts.append(_entries(acr, acronym_type(F.col("full_form")), "acronym", "acronyms"))
    if extra is not None:
        parts.append(extra.select("label", "name", F.lit("extra").alias("source")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("name").isNotNull() & (F.length("name") > 1))


# Corrected mode: sources whose entries match only the exact-case token
# (acronyms such as "AD" or "PET" would otherwise match "ad" and "pet").
EXACT_CASE_SOURCES = ("acronyms",)


def build_gazetteer(entries: DataFrame, exact_case_sources: tuple[str, ...] = EXACT_CASE_SOURCES) -> DataFrame:
    """Normalise entries with the text tokenizer; one row per (key, label, exact, ekey), best priority.

    ``key`` is always the lower-cased token sequence (the join key); ``exact``
    entries also keep their original-case spelling in ``ekey``.
    """
    prio = F.create_map(*[x for kv in SOURCE_PRIORITY.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    exact = F.col("source").isin(list(exact_case_sources)) if exact_case_sources else F.lit(False)
    raw_toks = F.regexp_extract_all(F.col("name"), F.lit(SPARK_TOKEN_RE), 0)
    # a name that a table repeats is cut into tokens once
    g = entries.select("label", "name", "source").distinct().select(
        "label", "name", "source", F.coalesce(prio[F.col("source")], F.lit(99)).alias("priority"),
        exact.alias("exact"), normalize_name(F.col("name")).alias("key"),
        F.when(exact, F.array_join(raw_toks, " ")).alias("ekey"), F.size(raw_toks).alias("n"))
    g = g.where(F.col("n") > 0)
    best = g.groupBy("key", "label", "exact", "ekey").agg(F.min(F.struct("priority", "source", "name")).alias("b"))
    return best.select("label", F.col("b.name").alias("name"), "key",
                       F.split("key", " ").getItem(0).alias("first"),
                       F.size(F.split("key", " ")).alias("n_tokens"),
                       F.col("b.source").alias("source"), F.col("b.priority").alias("priority"), "exact", "ekey")


def default_gazetteer(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    return build_gazetteer(vocabulary_entries(spark, extra=extra))


LABELLED_TOKEN_SCHEMA = T.StructType([
    T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("ner_tags", T.ArrayType(T.IntegerType())),
])
