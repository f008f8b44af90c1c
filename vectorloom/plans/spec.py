"""Column spec that drives profiling and vectorization."""

from __future__ import annotations

import re
from dataclasses import dataclass
from enum import Enum


# The words of the spec file.
class Kind(str, Enum):
    NUMERIC = "NUMERIC"
    DATE = "DATE"
    NOMINAL = "NOMINAL"


class Transform(str, Enum):
    COPY = "COPY"
    SKIP = "SKIP"
    BINARIZE = "BINARIZE"
    NORMALIZE = "NORMALIZE"
    LABEL = "LABEL"
    UNIQUE_ID = "UNIQUE_ID"
    ZEROMEAN_ZEROUNITVARIANCE = "ZEROMEAN_ZEROUNITVARIANCE"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: Kind
    transform: Transform

    def __post_init__(self) -> None:
        if self.kind is Kind.DATE:
            raise ValueError(f"{self.name}: DATE columns are not supported")
        if self.kind is Kind.NOMINAL and self.transform is Transform.BINARIZE:
            raise ValueError(f"{self.name}: a NOMINAL column cannot be binarized")


@dataclass(frozen=True)
class FeatureSpec:
    """Ordered columns of a relation; ``delimiter`` is a regular expression."""

    relation: str
    delimiter: str
    columns: tuple[ColumnSpec, ...]

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"repeated columns: {repeated}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def numeric(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.kind is Kind.NUMERIC]

    @property
    def nominal(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.kind is Kind.NOMINAL]

    @property
    def emitted(self) -> list[ColumnSpec]:
        """Columns that appear in the output, label included."""
        return [c for c in self.columns if c.transform is not Transform.SKIP]

    @property
    def features(self) -> list[ColumnSpec]:
        return [c for c in self.emitted if c.transform is not Transform.LABEL]

    @property
    def label(self) -> ColumnSpec | None:
        """The last LABEL column wins."""
        found = [c for c in self.columns if c.transform is Transform.LABEL]
        return found[-1] if found else None


    def to_text(self) -> str:
        """The form that ``load_spec`` reads."""
        head = [f"@RELATION {self.relation}", f"@DELIMITER {self.delimiter}"] if self.relation else [f"@DELIMITER {self.delimiter}"]
        lines = [f"@ATTRIBUTE {c.name} {c.kind.value} !{c.transform.value}" for c in self.columns]
        return "\n".join([*head, *lines])


def make_spec(relation: str, delimiter: str, *columns: tuple[str, str, str]) -> FeatureSpec:
    return FeatureSpec(
        relation, delimiter, tuple(ColumnSpec(n, Kind(k.upper()), Transform(t.upper())) for n, k, t in columns)
    )


def load_spec(text: str) -> FeatureSpec:
    """Read the ``@RELATION`` / ``@DELIMITER`` / ``@ATTRIBUTE name KIND !TRANSFORM`` form."""
    relation, delimiter, columns = "", ",", []
    for raw in text.splitlines():
        parts = raw.split()
        if not parts or parts[0].startswith("#"):
            continue
        match [parts[0].upper(), *parts[1:]]:
            case ["@RELATION", name]:
                relation = name
            case ["@DELIMITER", pattern]:
                re.compile(pattern)
                delimiter = pattern
            case ["@ATTRIBUTE", name, kind, transform] if transform.startswith("!"):
                columns.append((name, kind, transform[1:]))
            case _:
                raise ValueError(f"bad spec line: {raw!r}")
    return make_spec(relation, delimiter, *columns)
