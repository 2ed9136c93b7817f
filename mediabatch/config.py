"""Processing configuration of a batch run."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class ProcessingConfig:
    group_by_creator: bool = True
    rows: int = 5
    cols: int = 7
    max_images_per_creator: int | None = 35
    quality: int = 95
    max_workers: int = 8
    timeout: int = 30
    max_retries: int = 3

    @property
    def cap(self) -> int | None:
        """Images kept per creator; None and 0 both mean no limit."""
        return self.max_images_per_creator or None

    @property
    def cells(self) -> int:
        return self.rows * self.cols

    def hash_metadata(self) -> dict:
        """The part of the configuration that takes part in a creator's content hash."""
        return {
            "rows": self.rows,
            "cols": self.cols,
            "quality": self.quality,
            "max_images": self.max_images_per_creator,
        }

    def as_dict(self) -> dict:
        return asdict(self)

    def to_json(self) -> str:
        return json.dumps(self.as_dict())


CONFIG_KEYS = tuple(f.name for f in fields(ProcessingConfig))

DEFAULT_CONFIG = ProcessingConfig()
