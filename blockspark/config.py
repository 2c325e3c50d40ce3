"""Settings of the pipeline, with the three presets."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ChunkingConfig:
    """Token limits of a chunk. ``chunk_size`` is soft: text flushes at a blank block or at ``max_chunk_size``."""

    chunk_size: int = 1000
    overlap_tokens: int = 100
    min_chunk_size: int = 100
    max_chunk_size: int = 2000
    respect_sections: bool = True
    respect_paragraphs: bool = True
    include_anchors: bool = True
    token_method: str = "simple"


@dataclass(frozen=True)
class ProcessorConfig:
    """What a run produces: ``mode`` is markdown, ir or both."""

    mode: str = "markdown"
    dpi: int = 200
    with_anchors: bool = False
    enable_chunking: bool = False
    merge_pages: bool = False
    merge_context_chars: int = 500
    check_duplicates: bool = True
    chunking: ChunkingConfig = field(default_factory=ChunkingConfig)

    @classmethod
    def fast(cls) -> ProcessorConfig:
        return cls(dpi=150)

    @classmethod
    def high_quality(cls) -> ProcessorConfig:
        return cls(dpi=300, with_anchors=True, mode="both")

    @classmethod
    def rag(cls) -> ProcessorConfig:
        return cls(mode="both", enable_chunking=True, with_anchors=True)

    def with_chunks(self, **limits: int) -> ProcessorConfig:
        return replace(self, enable_chunking=True, chunking=replace(self.chunking, **limits))
