"""Settings. Credentials only ever come from the caller or the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

ENV_PREFIX = "TEXTPULSE_"


@dataclass(frozen=True)
class PulseConfig:
    # The defaults a deployment starts from.
    min_confidence: float = 0.3
    min_text_length: int = 10
    model_version: str = "1.2"
    # None: as much as there is. A cap bounds a micro-batch and with it the rate of the job.
    max_records_per_trigger: int | None = None
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    process_every: str = "10 seconds"
    dead_letter_every: str = "30 seconds"
    preview_every: str = "30 seconds"
    dead_letter_log_every: str = "1 minute"
    metrics_every: str = "2 minutes"
    late_by: str = "10 minutes"
    # None: every id for ever, so that no row is ever taken for a late one and dropped.
    remember_ids_for: str | None = None

    # Names that every deployment may set.
    bootstrap_servers: str = "localhost:9092"
    posts_topic: str = "posts"
    comments_topic: str = "comments"
    processed_topic: str = "processed-sentiment"
    dead_letter_topic: str = "dead-letters"
    checkpoint_root: str | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = field(default=None, repr=False)
    processed_table: str = "processed_content"
    dead_letter_table: str = "dead_letters"
    # A folder that dead letters wait in to be sent at their own pace; None: sent at once.
    dead_letter_staging: str | None = None

    def topic_for(self, content_type: str) -> str:
        return self.posts_topic if content_type == "post" else self.comments_topic

    def with_options(self, **options) -> PulseConfig:
        return replace(self, **options)

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> PulseConfig:
        """Take every field set as ``TEXTPULSE_<FIELD>``; keep defaults for the others."""
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):
            raw = env.get(ENV_PREFIX + f.name.upper())
            if raw is not None:
                found[f.name] = _from_text(raw, f.type)
        return cls(**found)


def _from_text(raw: str, kind: str) -> object:
    """A setting from its text; "none" or nothing unsets what may be unset."""
    if kind.endswith("| None") and raw.strip().lower() in ("", "none"):
        return None
    plain = kind.removesuffix(" | None")
    if plain == "bool":
        return raw.strip().lower() in ("true", "1", "yes")
    return {"int": int, "float": float}.get(plain, str)(raw)


DEFAULTS = PulseConfig()
