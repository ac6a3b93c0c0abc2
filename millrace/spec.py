"""Job description: the user's JSON config parsed into checked dataclasses.

Defaults live here and apply whenever a key is missing, blank or zero.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Names that configs, records and error rows must share with existing jobs.
OBJECT_KEY = "object_key"
FROM_KEY = "from_key"
TO_KEY = "to_key"
KINDS = ("vertex", "edge")
MODES = ("UPSERT", "DELETE", "MIX")
OPERATIONS = ("ADD", "UPDATE", "DELETE", "UPSERT")
STORE_TYPES = ("HIVE", "ES", "HBASE", "GDB", "ATLAS")
CHECK_DIRTY_ERROR = "CHECK_DIRTY_ERROR"
TYPE_ERROR = "TYPE_ERROR"
PARSE_ERROR = "PARSE_ERROR"
CHECK_ERROR = "CHECK_ERROR"
STREAMING_ERROR = "STREAMING_ERROR"
DIRTY_COUNT_ERROR = "DIRTY_COUNT_ERROR"
MESSAGE_BREAK = "##"

REQUIRED_SECTIONS = ("sources", "sinks", "schema", "errorInfo", "taskConfig")
REQUIRED_SINK_KEYS = {
    "HIVE": ("database", "table"),
    "ES": ("url", "index", "type"),
    "HBASE": ("url", "table"),
    "GDB": ("url", "user", "password", "database", "collection"),
    "ATLAS": ("url", "user", "password", "database", "collection"),
}


class SpecError(ValueError):
    """A config that cannot run; the message carries the check code."""

    def __init__(self, message: str):
        super().__init__(f"{CHECK_ERROR}{MESSAGE_BREAK}{message}")


def _blank(value: Any) -> bool:
    return value is None or str(value).strip() == ""


def _require(section: dict, keys, where: str) -> None:
    for key in keys:
        if key not in section:
            raise SpecError(f"{where}: key [{key}] is missing")


def _number(section: dict, key: str, default: int) -> int:
    value = section.get(key)
    return int(value) if value else default


@dataclass(frozen=True)
class FieldSpec:
    """One declared field: where it is in the message, its name and its type."""

    source: str
    target: str
    type: str = "STRING"
    required: bool = False

    def __post_init__(self):
        for name in ("source", "target", "type"):
            if _blank(getattr(self, name)):
                raise SpecError(f"schema field: [{name}] is blank")
        object.__setattr__(self, "type", self.type.upper())


@dataclass(frozen=True)
class SchemaSpec:
    """Field mapping, record kind and operation mode."""

    fields: tuple[FieldSpec, ...]
    kind: str = "vertex"
    mode: str = "UPSERT"
    op_field: str | None = None
    name: str = ""
    blank_is_null: bool = False

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "kind", (self.kind or "").lower())
        object.__setattr__(self, "mode", (self.mode or "").upper())
        if self.kind not in KINDS:
            raise SpecError(f"schema: type [{self.kind}] is not one of {KINDS}")
        if self.mode not in MODES:
            raise SpecError(f"operation: mode [{self.mode}] is not one of {MODES}")
        if not self.fields:
            raise SpecError("schema: no fields declared")
        needed = [OBJECT_KEY] + ([FROM_KEY, TO_KEY] if self.is_edge else [])
        if self.is_mix:
            if _blank(self.op_field):
                raise SpecError("operation: MIX mode needs operateField")
            needed.append(self.op_field)
        targets = [f.target for f in self.fields]
        for name in needed:
            if name not in targets:
                raise SpecError(f"schema: no field maps to [{name}]")
        if len(set(targets)) != len(targets):
            raise SpecError("schema: two fields share a targetName")

    @property
    def is_edge(self) -> bool:
        return self.kind == "edge"

    @property
    def is_mix(self) -> bool:
        return self.mode == "MIX"

    @classmethod
    def from_config(cls, section: dict) -> "SchemaSpec":
        _require(section, ("fields", "name", "type"), "schema")
        operation = section.get("operation") or {}
        return cls(
            fields=tuple(
                FieldSpec(
                    source=f.get("sourceName"),
                    target=f.get("targetName"),
                    type=f.get("type"),
                    required=str(f.get("isMain") or "N").upper() == "Y",
                )
                for f in section["fields"]
            ),
            kind=section["type"],
            mode=operation.get("mode"),
            op_field=operation.get("operateField"),
            name=section["name"],
        )


@dataclass(frozen=True)
class RollingPolicy:
    """When small files of a table are merged."""

    enabled: bool = False
    max_part_bytes: int = 128 * 1024 * 1024
    rollover_seconds: int = 60
    idle_seconds: int = 60
    check_seconds: int = 60
    files_per_group: int = 1024

    @classmethod
    def from_config(cls, section: dict | None) -> "RollingPolicy":
        section = section or {}
        mb = section.get("maxPartSize")
        return cls(
            enabled=bool(section.get("rolloverEnable", False)),
            # The config states mebibytes; zero switches the rule off.
            max_part_bytes=cls.max_part_bytes if mb is None else int(mb) * 1024 * 1024,
            rollover_seconds=int(section.get("rolloverInterval", cls.rollover_seconds)),
            idle_seconds=int(section.get("inactivityInterval", cls.idle_seconds)),
            check_seconds=_number(section, "rolloverCheckInterval", cls.check_seconds),
        )


@dataclass(frozen=True)
class SinkSpec:
    store_type: str
    options: dict = field(default_factory=dict)
    # Names the checkpoint whose batch numbers the sink gets.
    job_id: str = ""

    @property
    def rolling(self) -> RollingPolicy:
        return RollingPolicy.from_config(self.options.get("rollingPolicy"))

    @property
    def refresh_seconds(self) -> int:
        """How often the partitions of a table are looked for again; 0 never."""
        return int(self.options.get("refreshInterval") or 0)

    @property
    def fold_seconds(self) -> int:
        """How often a keyed table takes its changes into its base."""
        return _number(self.options, "foldInterval", 600)

    @property
    def batch_size(self) -> int:
        return _number(self.options, "importBatchSize", 2000)

    @classmethod
    def from_config(cls, section: dict) -> "SinkSpec":
        _require(section, ("storeType", "storeConfig"), "sink")
        store = str(section["storeType"]).upper()
        if store not in STORE_TYPES:
            raise SpecError(f"sink: storeType [{store}] is not one of {STORE_TYPES}")
        options = section["storeConfig"] or {}
        _require(options, REQUIRED_SINK_KEYS[store], f"{store} sink")
        return cls(store, options)


# Options of Spark's Kafka reader itself, which take no prefix, and consumer settings
# that the reader makes itself and refuses to be given.
KAFKA_READER_OPTIONS = (
    "startingOffsets", "startingTimestamp", "startingOffsetsByTimestamp", "startingOffsetsByTimestampStrategy",
    "endingOffsets", "endingTimestamp", "endingOffsetsByTimestamp", "failOnDataLoss", "maxOffsetsPerTrigger",
    "minOffsetsPerTrigger", "maxTriggerDelay", "minPartitions", "maxRecordsPerPartition", "groupIdPrefix",
    "includeHeaders", "kafkaConsumer.pollTimeoutMs", "fetchOffset.numRetries", "fetchOffset.retryIntervalMs",
)
KAFKA_SET_BY_SPARK = (
    "enable.auto.commit", "auto.commit.interval.ms", "key.deserializer", "value.deserializer", "interceptor.classes",
)


def _text(value) -> str:
    """An option's text: structures as JSON."""
    return value if isinstance(value, str) else json.dumps(value)


@dataclass(frozen=True)
class SourceSpec:
    """Where messages come from; `format` is kafka unless the config says otherwise."""

    format: str = "kafka"
    options: dict = field(default_factory=dict)
    path: str | None = None

    @classmethod
    def from_config(cls, section: dict) -> "SourceSpec":
        _require(section, ("storeType", "storeConfig"), "source")
        store = str(section["storeType"]).lower()
        config = section["storeConfig"] or {}
        if store != "kafka":
            if _blank(config.get("path")):
                raise SpecError(f"source: storeType [{store}] needs a path")
            extra = {k: str(v) for k, v in (config.get("config") or {}).items()}
            return cls(store, extra, config["path"])
        servers = config.get("servers")
        topics = config.get("topics") or config.get("topic")
        if _blank(servers) or _blank(topics):
            raise SpecError("source: servers or topic is blank")
        options = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topics,
            "kafka.group.id": config.get("groupId") or "millrace",
            "kafka.session.timeout.ms": "60000",
            # A first run takes the backlog; later ones go on from the checkpoint.
            "startingOffsets": "earliest",
        }
        given = {str(k): str(v) for k, v in (config.get("config") or {}).items()}
        given |= {k: _text(config[k]) for k in KAFKA_READER_OPTIONS if not _blank(config.get(k))}
        for key, value in given.items():
            if key == "auto.offset.reset":
                if value not in ("earliest", "latest"):
                    raise SpecError(f"source: auto.offset.reset [{value}] is neither earliest nor latest")
                options["startingOffsets"] = value
        for key, value in given.items():
            if key in KAFKA_READER_OPTIONS:
                options[key] = value
            elif key != "auto.offset.reset" and key not in KAFKA_SET_BY_SPARK:
                options[f"kafka.{key}"] = value
        if {"startingTimestamp", "startingOffsetsByTimestamp"} & set(given):
            if "startingOffsets" not in given and "auto.offset.reset" not in given:
                del options["startingOffsets"]
        return cls("kafka", options)


@dataclass(frozen=True)
class DirtySpec:
    """What happens to bad rows."""

    path: str | None = None
    enabled: bool = False
    rows_limit: int = 30000
    # -1 goes on whatever the number of bad rows; n >= 0 stops above n.
    handle_mode: int = -1
    task_instance_id: str = ""

    @classmethod
    def from_config(cls, section: dict) -> "DirtySpec":
        if str(section.get("storeType", "")).lower() != "file":
            raise SpecError("dirtyData: storeType must be file")
        config = section.get("config") or {}
        if _blank(config.get("path")):
            raise SpecError("dirtyData: path is blank")
        return cls(
            path=config["path"],
            enabled=bool(section.get("storeEnabled", False)),
            rows_limit=int(section.get("storeRowsLimit", cls.rows_limit)),
            handle_mode=int(section.get("handleMode", cls.handle_mode)),
            task_instance_id=section.get("taskInstanceId") or "",
        )


@dataclass(frozen=True)
class TaskSpec:
    checkpoint: str = ""
    parallelism: int = 3
    checkpoint_ms: int = 60_000
    batch_ms: int = 10_000
    restarts: int = 3
    # Session settings of the job.
    settings: dict = field(default_factory=dict)

    @classmethod
    def from_config(cls, section: dict) -> "TaskSpec":
        if _blank(section.get("checkPoint")):
            raise SpecError("taskConfig: checkPoint is blank")
        return cls(
            checkpoint=section["checkPoint"],
            parallelism=_number(section, "parallelism", cls.parallelism),
            checkpoint_ms=_number(section, "checkpointInterval", cls.checkpoint_ms),
            batch_ms=_number(section, "batchInterval", cls.batch_ms),
            restarts=_number(section, "restart", cls.restarts),
            settings=cls._settings(section),
        )

    @staticmethod
    def _settings(section: dict) -> dict[str, str]:
        """The session settings in `config`. Others are settings of another engine and are named in a
        warning. `parallelism` and `checkpointInterval` of old configs are read but have no effect:
        the cluster's cores and the partition settings decide the one, every batch is a checkpoint."""
        settings = {}
        for key, value in (section.get("config") or {}).items():
            if str(key).startswith("spark.sql."):
                settings[str(key)] = _text(value)
            else:
                warnings.warn(f"taskConfig: config [{key}] is no session setting (spark.sql.*) and has no effect")
        return settings


@dataclass(frozen=True)
class JobSpec:
    """A whole loading job."""

    schema: SchemaSpec
    source: SourceSpec = SourceSpec()
    sinks: tuple[SinkSpec, ...] = ()
    dirty: DirtySpec = DirtySpec()
    task: TaskSpec = TaskSpec()
    log_path: str | None = None

    @property
    def affected_store(self) -> str:
        names = ["GDB" if s.store_type == "ATLAS" else s.store_type for s in self.sinks]
        return ",".join(names)

    @classmethod
    def from_config(cls, config: str | dict) -> "JobSpec":
        """Read a config given as a dict, JSON text or the path of a local file."""
        if isinstance(config, str):
            if _blank(config):
                raise SpecError("no config given")
            text = config if config.lstrip().startswith("{") else Path(config.removeprefix("file://")).read_text("utf-8")
            config = json.loads(text)
        _require(config, REQUIRED_SECTIONS, "config")
        if not config["sinks"]:
            raise SpecError("sinks: none declared")
        if not config["sources"]:
            raise SpecError("sources: none declared")
        errors = config["errorInfo"]
        _require(errors, ("dirtyData", "logInfo"), "errorInfo")
        log = errors["logInfo"]
        if str(log.get("storeType", "")).lower() != "file":
            raise SpecError("logInfo: storeType must be file")
        return cls(
            schema=SchemaSpec.from_config(config["schema"]),
            source=SourceSpec.from_config(config["sources"][0]),
            sinks=tuple(SinkSpec.from_config(s) for s in config["sinks"]),
            dirty=DirtySpec.from_config(errors["dirtyData"]),
            task=TaskSpec.from_config(config["taskConfig"]),
            log_path=(log.get("config") or {}).get("path"),
        )
