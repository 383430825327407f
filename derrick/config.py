"""Connection settings for the operational database and the lake."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass
class LakeConfig:
    """Where tables come from and where marts go.

    Read from the environment by :meth:`from_env`; there are no default
    credentials. ``jdbc_url`` empty means the tables are read from
    ``source_root`` (one Parquet folder per table).
    """
    jdbc_url: str = ""
    jdbc_user: str = ""
    jdbc_password: str = field(default="", repr=False)
    jdbc_driver: str = ""
    source_root: str = ""
    lake_root: str = ""
    mart_schema: str = "mart"
    s3_endpoint: str = ""
    s3_access_key: str = field(default="", repr=False)
    s3_secret_key: str = field(default="", repr=False)

    @classmethod
    def from_env(cls, prefix: str = "DERRICK_") -> "LakeConfig":
        def get(name: str, default: str = "") -> str:
            return os.environ.get(prefix + name, default)
        return cls(jdbc_url=get("JDBC_URL"), jdbc_user=get("JDBC_USER"),
                   jdbc_password=get("JDBC_PASSWORD"), jdbc_driver=get("JDBC_DRIVER"),
                   source_root=get("SOURCE_ROOT"), lake_root=get("LAKE_ROOT"),
                   mart_schema=get("MART_SCHEMA", "mart"), s3_endpoint=get("S3_ENDPOINT"),
                   s3_access_key=get("S3_ACCESS_KEY"), s3_secret_key=get("S3_SECRET_KEY"))

    def jdbc_properties(self) -> dict[str, str]:
        props = {"user": self.jdbc_user, "password": self.jdbc_password}
        if self.jdbc_driver:
            props["driver"] = self.jdbc_driver
        return {k: v for k, v in props.items() if v}

    def spark_conf(self) -> dict[str, str]:
        """Hadoop S3A options for an S3-compatible lake endpoint."""
        if not self.s3_endpoint:
            return {}
        return {"spark.hadoop.fs.s3a.endpoint": self.s3_endpoint,
                "spark.hadoop.fs.s3a.access.key": self.s3_access_key,
                "spark.hadoop.fs.s3a.secret.key": self.s3_secret_key,
                "spark.hadoop.fs.s3a.path.style.access": "true"}
