"""What the commands take where no flag says otherwise. What a live browser would need (headless mode, scrolls, delays) has no place here."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Each field can be set by an environment variable: PLACEFLOW_ and its name in capitals."""

    max_pages: int = 10
    min_entries: int = 40
    save_freq: int = 10_000
    sample_count: int = 5
    sample_seed: int = 42
    title: str = "Places"
    facilities_file: str = "places.parquet"
    failed_file: str = "failed.csv"

    @classmethod
    def read(cls, environment: dict[str, str] | None = None) -> Settings:
        env = os.environ if environment is None else environment
        given = {f.name: env[name] for f in fields(cls) if (name := f"PLACEFLOW_{f.name.upper()}") in env}
        return cls(**{n: type(getattr(cls, n))(v) for n, v in given.items()})
