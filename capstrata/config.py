"""Configuration of filters and pipelines, from and to YAML."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields


@dataclass(frozen=True)
class FilterConfig:
    min_text_len: int = 10
    max_text_len: int = 512
    min_word_count: int = 3
    max_word_count: int = 100
    allow_languages: tuple[str, ...] = ("en", "zh")
    check_repeated_ngrams: bool = True
    use_clip_filter: bool = True
    min_clip_score: float = 0.20
    clip_model: str = "ViT-B-32"  # this, clip_pretrained and the device are handed to the scorer that is plugged in
    clip_pretrained: str = "openai"
    clip_batch_size: int = 256
    use_aesthetic_filter: bool = False
    min_aesthetic_score: float = 4.5
    min_image_size: int = 64
    max_aspect_ratio: float = 3.0

    def __post_init__(self):
        object.__setattr__(self, "allow_languages", tuple(self.allow_languages))


@dataclass(frozen=True)
class PipelineConfig:
    input_path: str = ""
    output_path: str = "output/"
    image_root: str = ""
    output_format: str = "jsonl"
    filter: FilterConfig = field(default_factory=FilterConfig)
    run_dedup: bool = True
    dedup_image_method: str = "phash"
    dedup_image_threshold: int = 5
    dedup_text_threshold: int = 3
    run_augmentation: bool = False
    augmentation_use_templates: bool = True
    augmentation_use_synonyms: bool = True
    augmentation_use_back_translation: bool = False  # needs a translator
    augmentation_templates: int = 1
    augmentation_synonym_p: float = 0.3
    augmentation_seed: int = 42
    device: str = "auto"
    num_workers: int = 4
    batch_size: int = 256
    log_level: str = "INFO"
    log_every: int = 1000  # accepted; Spark reports the progress of its jobs
    min_score: float = 0.0
    keep_columns: bool = True

    def __post_init__(self):
        if self.output_format not in ("jsonl", "parquet"):
            raise ValueError(f"unknown output format: {self.output_format}")
        if self.dedup_image_method not in ("phash", "dhash"):
            raise ValueError(f"unknown image method: {self.dedup_image_method}")

    @classmethod
    def from_dict(cls, values: dict) -> PipelineConfig:
        """Unknown keys raise TypeError, at both levels."""
        if not isinstance(values, dict):
            raise TypeError("a configuration is a mapping")
        values = dict(values)
        nested = values.pop("filter", {})
        if not isinstance(nested, dict):
            raise TypeError("filter is a mapping")
        return cls(**values, filter=FilterConfig(**nested))

    @classmethod
    def from_yaml(cls, path: str) -> PipelineConfig:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f))

    def to_yaml(self, path: str) -> None:
        import yaml

        values = asdict(self)
        values["filter"]["allow_languages"] = list(self.filter.allow_languages)
        with open(path, "w", encoding="utf-8") as f:
            yaml.safe_dump(values, f, allow_unicode=True, sort_keys=False)

    def resolved_device(self) -> str:
        """The device named, or the one at hand for "auto"."""
        if self.device != "auto":
            return self.device
        try:
            import onnxruntime

            return "cuda" if "CUDAExecutionProvider" in onnxruntime.get_available_providers() else "cpu"
        except ImportError:
            return "cpu"


FILTER_FIELDS = tuple(f.name for f in fields(FilterConfig))
