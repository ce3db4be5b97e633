"""Declared shape of an input table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Columns in order, which must be numeric, the target and its allowed values.

    ``numeric`` is ``None`` when the declaration has no numeric list; the numeric
    check is then skipped.
    """

    columns: tuple[tuple[str, str], ...]
    numeric: tuple[str, ...] | None
    target: str = "Result"
    labels: tuple[int, ...] = (-1, 1)
    generated: tuple[str, ...] = ("id", "created_at")
    n_declared: int | None = field(default=None)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def features(self) -> list[str]:
        return [name for name in self.names if name != self.target]

    @property
    def expected_columns(self) -> int:
        return len(self.columns) if self.n_declared is None else self.n_declared

    @property
    def struct(self) -> T.StructType:
        ddl = ", ".join(f"`{name}` {SPARK_TYPES.get(t, t)}" for name, t in self.columns)
        return T.StructType.fromDDL(ddl)

    @classmethod
    def from_dict(cls, doc: dict) -> "TableSpec":
        """Build from the declaration; a document without ``columns`` is the old
        layout, whose top-level keys are counted as the columns."""
        target = doc.get("target_column", "Result")
        numeric = doc.get("numerical_columns")
        if "columns" in doc:
            columns = tuple((str(k), str(v)) for entry in doc["columns"] for k, v in entry.items())
            return cls(columns, tuple(numeric) if numeric is not None else None, target)
        return cls((), tuple(numeric) if numeric is not None else None, target, n_declared=len(doc))

    @classmethod
    def from_yaml(cls, path: str) -> "TableSpec":
        import yaml

        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(yaml.safe_load(handle))


# Names used in declarations and the Spark type each stands for.
SPARK_TYPES = {"int64": "bigint", "int32": "int", "float64": "double", "float32": "float", "object": "string", "bool": "boolean"}

# The web-site trait columns of the base table, in table order.
PHISHING_COLUMNS = (
    "having_IP_Address",
    "URL_Length",
    "Shortining_Service",
    "having_At_Symbol",
    "double_slash_redirecting",
    "Prefix_Suffix",
    "having_Sub_Domain",
    "SSLfinal_State",
    "Domain_registeration_length",
    "Favicon",
    "port",
    "HTTPS_token",
    "Request_URL",
    "URL_of_Anchor",
    "Links_in_tags",
    "SFH",
    "Submitting_to_email",
    "Abnormal_URL",
    "Redirect",
    "on_mouseover",
    "RightClick",
    "popUpWidnow",
    "Iframe",
    "age_of_domain",
    "DNSRecord",
    "web_traffic",
    "Page_Rank",
    "Google_Index",
    "Links_pointing_to_page",
    "Statistical_report",
    "Result",
)

PHISHING = TableSpec(columns=tuple((name, "int64") for name in PHISHING_COLUMNS), numeric=PHISHING_COLUMNS)
