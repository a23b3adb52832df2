"""Job settings read from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobSettings:
    bootstrap_servers: str = "kafka:9092"
    topic: str = "purchase-events"
    group_id: str = "tidemark"
    jdbc_url: str = "jdbc:mysql://mysql:3306/tidemark?rewriteBatchedStatements=true"
    jdbc_username: str = "tidemark"
    jdbc_password: str = field(default="", repr=False)

    @classmethod
    def from_environment(cls, environ: Mapping[str, str] | None = None) -> JobSettings:
        env = os.environ if environ is None else environ
        names = {
            "bootstrap_servers": "TIDEMARK_KAFKA_BOOTSTRAP",
            "topic": "TIDEMARK_KAFKA_TOPIC",
            "group_id": "TIDEMARK_KAFKA_GROUP_ID",
            "jdbc_url": "TIDEMARK_JDBC_URL",
            "jdbc_username": "TIDEMARK_JDBC_USERNAME",
            "jdbc_password": "TIDEMARK_JDBC_PASSWORD",
        }
        return cls(**{attr: env[name] for attr, name in names.items() if name in env})
