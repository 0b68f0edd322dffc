"""Settings of the operators, with defaults that a file of KEY=value lines may override."""

from __future__ import annotations

import dataclasses


@dataclasses.dataclass(frozen=True)
class Settings:
    # The markers of prompts, the longest prompt in code points, and tokens asked for by default.
    fim_prefix: str = "<fim_prefix>"
    fim_suffix: str = "<fim_suffix>"
    fim_middle: str = "<fim_middle>"
    max_input_length: int = 512
    default_max_new_tokens: int = 30

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.fim_prefix, self.fim_suffix, self.fim_middle


DEFAULT = Settings()


def load(text: str = "") -> Settings:
    """Settings overridden by lines such as `MAX_INPUT_LENGTH=256`; unknown keys, blank lines and # comments are skipped."""
    kinds = {f.name: type(f.default) for f in dataclasses.fields(Settings)}
    given = dict(line.split("=", 1) for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
    named = {k.strip().lower(): v.strip().strip("'\"") for k, v in given.items()}
    return Settings(**{k: kinds[k](v) for k, v in named.items() if k in kinds})
