"""Behaviour options of the operators; every default corrects output or adds none."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    column_sort: bool = True
    runin_pairs: bool = False
    table_gate: bool = True
    table_keywords: tuple[str, ...] = ()
    header_collapse: bool = True
    frame_reject: bool = True
    frame_content_columns: bool = True
    furniture_reject: bool = True
    reversed_reject: bool = True
    table_merge: bool = False
    review_queue: bool = False
    book_table_check: bool = True
    same_page_merge: bool = True
    ocr_gutter: bool = False
    ocr_empty_page_max: float = 0.35
    ocr_min_chars_per_page: int = 200
