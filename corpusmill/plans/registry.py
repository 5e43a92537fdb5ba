"""Names of components; lookup ignores case and underscores, so every spelling in use finds its class."""

from __future__ import annotations

from collections.abc import Callable

from corpusmill.operators import ImagePhashDeduplicator, ImageQualityFilter, SemanticDeduplicator, TextExactDeduplicator, TextLengthFilter, UrlFilter
from corpusmill.operators.html import HtmlTextRefiner
from corpusmill.operators.images import ImageAestheticQualityRefiner, ImageAIGCDetectorRefiner, ImageClipEmbeddingRefiner, ImageMetadataRefiner, ImageSigLIPEmbeddingRefiner, ImageTechnicalQualityRefiner, ImageVisualDegradationsRefiner
from corpusmill.sources.loaders import CommonCrawlLoader, DatasetLoader, ImageFolderLoader
from corpusmill.sources.writers import IcebergDataWriter, ParquetDataWriter


class Registry:
    def __init__(self, kind: str):
        self.kind = kind
        self._classes: dict[str, Callable] = {}
        self._names: dict[str, str] = {}

    @staticmethod
    def _fold(name: str) -> str:
        return name.replace("_", "").replace("-", "").lower()

    def register(self, name: str, cls: Callable) -> None:
        self._classes[self._fold(name)] = cls
        self._names[self._fold(name)] = name

    def get(self, name: str) -> Callable:
        found = self._classes.get(self._fold(name))
        if found is None:
            raise ValueError(f"unknown {self.kind} {name!r}; there are {', '.join(self.names())}")
        return found

    def create(self, name: str, params: dict | None = None):
        return self.get(name)(**(params or {}))

    def names(self) -> list[str]:
        return sorted(self._names.values())


OPERATORS, LOADERS, WRITERS = Registry("operator"), Registry("loader"), Registry("writer")
for _cls in (UrlFilter, TextLengthFilter, ImageQualityFilter, TextExactDeduplicator, ImagePhashDeduplicator, SemanticDeduplicator, HtmlTextRefiner, ImageMetadataRefiner, ImageTechnicalQualityRefiner, ImageVisualDegradationsRefiner, ImageClipEmbeddingRefiner, ImageSigLIPEmbeddingRefiner, ImageAestheticQualityRefiner, ImageAIGCDetectorRefiner):
    OPERATORS.register(_cls.__name__, _cls)
for _cls in (DatasetLoader, ImageFolderLoader, CommonCrawlLoader):
    LOADERS.register(_cls.__name__, _cls)
LOADERS.register("HuggingFaceLoader", DatasetLoader)
for _cls in (ParquetDataWriter, IcebergDataWriter):
    WRITERS.register(_cls.__name__, _cls)
