"""End-to-end article plans.

``extract_knowledge`` is the per-article extraction (entities, aliases,
relationships) over an ``(doc_id, text)`` DataFrame; ``process_pages`` is the
full page-table pipeline (assembly, cleaning, metadata, extraction).  All
articles go through one plan.  The text of an article is shuffled by the assembly of its
pages: matches leave the scan with the text around them, and what follows (islands,
first occurrences, pairs) exchanges only those.  Where a scorer's spans block matches these
leave it bare, and the text is shuffled once more, to the few first occurrences that are left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.config import COMPAT, PipelineConfig
from pagewright.functions import metadata as M
from pagewright.functions import text as T
from pagewright.operators import hooks as HK
from pagewright.operators.aliases import extract_aliases
from pagewright.operators.gazetteer import Gazetteer, match_gazetteer
from pagewright.operators.partitioning import ROW, stored, with_row
from pagewright.operators.relations import entity_pairs, pair_text, per_article_counts, score_relations
from pagewright.operators.spans import attach_context, attach_windows, drop_overlapping, first_occurrence, resolve_overlaps
from pagewright.sources.pages import assemble_articles

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


@dataclass
class Extraction:
    entities: DataFrame      # doc_id, label, text, start, end, context, source (first occurrences)
    mentions: DataFrame      # every kept span, before the per-label dedupe
    aliases: DataFrame       # doc_id, term, alias
    relations: DataFrame     # doc_id, entity1, entity1_type, entity2, entity2_type, relation, confidence, context


def gazetteer_of(gazetteer: DataFrame | Gazetteer, cfg: PipelineConfig = PipelineConfig()) -> Gazetteer:
    if isinstance(gazetteer, Gazetteer):
        return gazetteer
    return Gazetteer(gazetteer, cfg.extract.broadcast_max_bytes, cfg.extract.inline_firsts)


def entity_mentions(docs: DataFrame, gazetteer: DataFrame | Gazetteer, cfg: PipelineConfig = PipelineConfig(),
                    blockers: DataFrame | None = None, before: int = 0, after: int = 0) -> DataFrame:
    """J1 + J8: non-overlapping vocabulary spans with their surface text, and with the text
    around them (``win``) where ``before``/``after`` ask for it, and the row where articles name theirs.

    ``blockers`` (doc_id, start, end): existing entities, e.g. from a model
    hook, that gazetteer matches may not overlap (reference behaviour).
    """
    cands = match_gazetteer(docs, gazetteer_of(gazetteer, cfg), before, after, cfg.extract.chunk_chars)
    if blockers is not None:
        cands = drop_overlapping(cands, blockers)
    kept = resolve_overlaps(cands)
    return kept.select("doc_id", "label", "source", "start", "end", "text", *[c for c in (ROW, "win_start", "win") if c in kept.columns])


def first_entities(docs: DataFrame, gazetteer: DataFrame | Gazetteer, cfg: PipelineConfig = PipelineConfig(),
                   blockers: DataFrame | None = None) -> DataFrame:
    """A5 + E3: first occurrence per (article, label, lower text), and its context."""
    reach = 0 if cfg.extract.chunk_chars else cfg.extract.context_chars
    ments = entity_mentions(docs, gazetteer, cfg, blockers, reach, reach)
    return attach_context(first_occurrence(ments), docs, cfg.extract.context_chars) \
        .select("doc_id", "label", "text", "start", "end", "context", "source")


def extract_knowledge(docs: DataFrame, gazetteer: DataFrame | Gazetteer, cfg: PipelineConfig = PipelineConfig(),
                      span_scorer: Scorer | None = None, word_scorer: Scorer | None = None) -> Extraction:
    """Entities, mentions, aliases and relationships of ``(doc_id, text)``.

    ``span_scorer`` (X4) maps a pandas frame ``(doc_id, text)`` to existing entities
    ``(doc_id, label, start, end)``: they are entities themselves, and no vocabulary match
    may overlap them.  ``word_scorer`` (X1) gives ``(doc_id, label, word)``; words that the text
    holds join the entities unless their label has the same text already (J9, U2).  Each
    scorer sees every article once.

    With a ``span_scorer`` matches are exchanged and written without the text around them, and
    the entities take it from the articles at the end; where rows share an id and have the same
    entity at the same place, from one of them.
    """
    ex = cfg.extract
    whole = not ex.chunk_chars
    before, after = (max(ex.context_chars, ex.pair_context_chars), max(ex.context_chars, ex.max_pair_gap, ex.pair_context_chars)) if whole else (0, 0)
    rows, reach = docs, (before, after)
    blockers = None
    if span_scorer is not None:
        rows, reach = with_row(docs) if whole else docs, (0, 0)
        blockers = stored(HK.model_spans(rows, span_scorer))
    # the candidates are written inside, so mentions, entities, pairs and counts match once
    mentions = entity_mentions(rows, gazetteer, cfg, blockers, *reach)
    if blockers is not None:
        mentions = mentions.unionByName(blockers.select(*mentions.columns))
    ents = first_occurrence(mentions)
    if word_scorer is not None:
        ents = HK.merge_entities(ents, HK.locate_words(rows, word_scorer, *reach).select(*ents.columns))
    if ROW in ents.columns:
        ents = attach_windows(ents, rows, before, after)
    ents = stored(attach_context(ents, docs, ex.context_chars))
    pairs = entity_pairs(ents, ex.max_pair_gap, ex.range_bucket)
    rels = score_relations(pair_text(pairs, docs, ex.pair_context_chars), ex.min_confidence)
    return Extraction(ents.select("doc_id", "label", "text", "start", "end", "context", "source"),
                      mentions.select("doc_id", "label", "source", "start", "end", "text"), extract_aliases(docs), rels)


def clean_articles(pages: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Pages -> ``(doc_id, raw_text, text)`` where ``text`` is the cleaned article.

    compat: linebreaks removed per page before the line filter (reference order).
    corrected: pages keep their lines, the filter runs per line, citations
    drop bracketed numbers only.
    """
    if cfg.mode == COMPAT:
        arts = assemble_articles(pages, cfg.pages)
        cleaned = T.clean_article(F.col("raw_text"), cfg.clean.lowercase, cfg.clean.remove_citations)
    else:
        from pagewright.config import PageConfig
        arts = assemble_articles(pages, PageConfig(remove_linebreaks=False,
                                                   remove_headers_footers=cfg.pages.remove_headers_footers))
        cleaned = T.clean_article(F.col("raw_text"), cfg.clean.lowercase, cfg.clean.remove_citations,
                                  corrected_citations=True)
    return arts.select("doc_id", "raw_text", cleaned.alias("text"))


def process_pages(pages: DataFrame, gazetteer: DataFrame | Gazetteer, cfg: PipelineConfig = PipelineConfig(),
                  span_scorer: Scorer | None = None, word_scorer: Scorer | None = None, name_scorer: Scorer | None = None):
    """The whole article pipeline: returns (articles, Extraction, counts).

    Metadata comes from the cleaned text in compat mode (as the reference
    does) and from the raw assembled text in corrected mode.  With
    ``cfg.clean.remove_names`` what ``name_scorer`` calls a PERSON is masked in the cleaned
    text (H5) before anything is read from it.  The cleaned articles are written
    once, and metadata, aliases, scorers and matching read them.
    """
    arts = clean_articles(pages, cfg)
    if cfg.clean.remove_names:
        if name_scorer is None:
            raise ValueError("remove_names needs a scorer that finds names")
        arts = HK.mask_scored_names(arts, name_scorer, word_aligned=cfg.mode != COMPAT)
    arts = stored(arts)
    default = F.lit(cfg.default_date) if cfg.default_date else None
    meta_src = F.col("text") if cfg.mode == COMPAT else F.col("raw_text")
    articles = arts.select("doc_id", "text", M.metadata_struct(meta_src, default).alias("m")) \
        .select("doc_id", "m.*", F.col("text").alias("processed_text"))
    found = extract_knowledge(arts.select("doc_id", "text"), gazetteer, cfg, span_scorer, word_scorer)
    counts = per_article_counts(arts, found.entities, found.relations, found.aliases)
    return articles, found, counts
