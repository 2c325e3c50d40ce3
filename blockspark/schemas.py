"""Schemas of the tables that move through the library."""

from __future__ import annotations

DOCUMENTS = "doc_id string, source_path string, filename string, total_pages int, created_at string, parser_version string, title string, authors array<string>"
PAGES = "doc_id string, page_num int, width double, height double, dpi int"
OCR_LINE = "struct<text:string,confidence:double,box:array<array<double>>,box_page_absolute:boolean>"
BLOCKS = (
    "doc_id string, page int, pos int, block_id string, type string, bbox array<double>, reading_order int, text string, markdown string, lang string, confidence double, source_hash string, "
    f"parser_source string, caption string, translation string, image_path string, anchor string, ocr_lines array<{OCR_LINE}>, raw_data map<string,string>"
)
CHUNKS = (
    "chunk_id string, doc_id string, page_start int, page_end int, block_ids array<string>, section string, text string, token_count int, char_count int, "
    "reading_order_start int, reading_order_end int, anchors array<string>, translation string, embedding array<float>"
)
ELEMENTS = "struct<page_elements:array<struct<type:string,content:string,level:int,metadata:map<string,string>>>>"
REGISTRY = "kind string, hash string, path string, date string, preview string, seq long"
OCR_CACHE = "image_hash string, text string, lines_json string, confidence double, lang string, created_at string"
VLM_CACHE = "cache_key string, image_hash string, prompt_hash string, caption string, structured_json string, model string, created_at string"
LAYOUT_CACHE = "image_hash string, blocks_json string, model string, created_at string"
DOC_STATUS = "doc_id string, source_path string, status string, pages_processed int, total_pages int, last_updated string"
QUEUE_EVENTS = "id long, path string, priority string, tags array<string>, status string, ts string, seq long"

#: Block types that carry text, those that carry pictures, and the short forms in anchors.
TEXT_TYPES = ("caption", "footer", "footnote", "header", "section_header", "text", "title")
VISUAL_TYPES = ("chart", "figure", "formula", "picture", "table")
ABBREVIATIONS = {"chart": "cht", "figure": "fig", "formula": "eq", "picture": "fig", "section_header": "sec", "table": "tbl", "text": "txt", "title": "ttl"}
#: Element types of the model's answers and the block types they become.
ELEMENT_TYPES = {"abstract": "text", "affiliation": "text", "author": "text", "figure": "figure", "paragraph": "text", "section": "title", "subsection": "title", "table": "table", "title": "title"}
PARSER_VERSION, PARSER_SOURCE, MODEL_CONFIDENCE = "2.0.0", "qwenvl", 0.95
