"""Vocabulary matching as a join, for vocabularies of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.regex import WORD
from postloom.functions.skills import skill_text
from postloom.operators.substring_index import HASH, hashed_texts, text_hash
from postloom.operators.term_trie import build_trie, trie_reports


def match_terms(
    df: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term",
) -> DataFrame:
    """``(key, term)`` for every vocabulary term that occurs in a text as whole words.

    The terms are a prefix tree (:mod:`postloom.operators.term_trie`): texts stay where they are
    read, only what meets the tree is shuffled, and rows meet what was found by a hash of the text.
    Terms without a word, or with a blank at an end, occur nowhere.
    """
    name = F.col(term)
    listed = terms.where(
        name.rlike(f"[{WORD}]") & ~name.startswith(" ") & ~name.endswith(" ")).select(
        name.alias("term"), name.alias("report"))
    plain: Column = skill_text(F.col(text))
    found = trie_reports(hashed_texts(df, plain), build_trie(listed))
    rows = df.select(key, *text_hash(plain)).join(found, HASH)
    return rows.select(key, F.explode("reports").alias(term))
