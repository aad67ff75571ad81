"""Pipeline configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from eventlake import constants as C


@dataclass(frozen=True)
class PipelineConfig:
    # Zone in which event-time text is read and the `date` property is written.
    time_zone: str = "Asia/Shanghai"
    # "token": a rule applies when its project is one item of the record's project
    # list; "contains": substring test, as the reference does.
    rule_match: str = "token"
    # The reference also sends rows that failed validation to the main output.
    drop_invalid: bool = False
    # Deal the records round-robin to this many tasks before they are parsed
    # (for inputs of a few small files); None: take the input's partitions.
    input_partitions: int | None = None
    csv_fields: dict = field(default_factory=lambda: dict(C.CSV_FIELDS))
    csv_separator: str = C.CSV_SEPARATOR
