"""Declarative profiles: what differs between device generations and message families.

One pipeline (``shoal.plans.stages``) runs every profile; a profile is plain data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

# Event names the V5 and V5c event streams let through (95 names, in
# their original order).
DEFAULT_ALLOWED_EVENTS = (
    "AD-REPLACEMENT",
    "AD-TRIGGER",
    "APP-LAUNCH",
    "BOM",
    "BOOTFLOW-ERROR",
    "BROKER-UPDATE",
    "BTA-CALL",
    "CATCH-UP",
    "CEC",
    "CONNECTED-DEFLECT",
    "CONSUMER-PVR",
    "CPVR-SYS",
    "CPVR-USER",
    "CPVR-USR-ERROR",
    "CPVR-VIEW-ERROR",
    "CUTV",
    "DR-SELF",
    "DRM-ERROR",
    "DTV-CH",
    "DTV-GUIDE",
    "DTV-SEARCH",
    "HARD-PWR-OFF",
    "HDMI",
    "HOTKEY",
    "HUB",
    "INFO-URL",
    "INTERACTIVITY-PAGE",
    "ISOLATED-STATE",
    "LANG-SET-SP",
    "LANGUAGE-SETTINGS",
    "LINEAR",
    "MCAST-ERR",
    "MENU",
    "MULTICAST-ERROR",
    "MUSIC-GUIDE",
    "NETFLIX",
    "NETWORK-PVR",
    "NETWORK_PVR",
    "NO-SIGNAL",
    "NPVR-SYS",
    "NPVR-USER",
    "NPVR-USR-ERROR",
    "NPVR-VIEW-ERROR",
    "NTFLX",
    "ON-DEMAND",
    "OPTIN",
    "P",
    "PLAYER",
    "POWER-CYCLE",
    "PRGM-CH",
    "PWR-ACT-OFF",
    "PWR-ACT-STBY",
    "PWR-NETSTBY-ACT",
    "PWR-NETSTBY-OFF",
    "PWR-NETSTBY-STBY-WOL",
    "PWR-NETSTBY-STBY-WUT",
    "PWR-OFF-ACT",
    "PWR-ON",
    "PWR-SLEEP-ACT",
    "PWR-SLEEP-OFF",
    "PWR-SLEEP-STBY-WUT",
    "PWR-STBY-ACT",
    "PWR-STBY-NETSTBY-ERR",
    "PWR-STBY-OFF",
    "PWR-STBY-SLEEP-ERR",
    "QOE",
    "RADIO",
    "RATE-REQUEST",
    "RECO-BROWSE",
    "RECOMMENDATION-BROWSE",
    "RTSP",
    "SEARCH-BROWSE",
    "SETTINGS",
    "SLEEP",
    "SOFTWARE-UPGRADE",
    "STANDBY",
    "STBSTATUS-BASICDTV",
    "STBSTATUS-BasicDTV",
    "STBSTATUS-FULLSERVICE",
    "SW-UPGRADE",
    "SYSTEM-ERROR",
    "TA-REPL",
    "TA-TRIG",
    "TIME-SHIFT",
    "TSTV",
    "TSU-FINISHED",
    "TSU-START",
    "UPNP",
    "UPSELL",
    "VOD-GUIDE",
    "VOD-PREVIEW",
    "VOD-RENT-VHP",
    "VOD-RENTAL",
    "VOD-VIEW",
    "VQE-CONFIG-ERROR",
)

# Payload columns the V7 event table stores as DECIMAL(18,0), in their
# original order (event_time is listed twice there; casting it twice is the same).
V7_DECIMAL_COLUMNS = (
    "scan_start_time",
    "event_time",
    "eventcounter",
    "event_counter",
    "viewing_duration",
    "program_duration",
    "time_position",
    "event_time",
    "app_duration",
)


@dataclass(frozen=True)
class Profile:
    """Everything one stream needs beyond the shared pipeline."""

    name: str  # stream (and default table) name
    family: str  # "metrics" | "events"
    payload: str  # root key of the payload object, flattened in stage 2
    time_field: str  # epoch key (seconds or milliseconds) at any depth
    date_key: str  # root key the derived date is written under
    side_fields: tuple[str, ...]  # root keys kept next to the payload in stage 2
    hw_stamp: str  # value written into every hw_type
    partitions: tuple[str, ...]  # stage-2 table partition columns
    drops: tuple[str, ...] = ()  # stage-2 columns dropped if present (taken literally)
    copies: tuple[tuple[str, str], ...] = ()  # (target, source) column copies, in order
    type_hygiene: bool = False  # F7 on event_type
    allow_list: tuple[str, ...] | DataFrame | None = None  # F5/F6 (a DataFrame: its first column)
    allow_scope: str = "any_column"  # "any_column" (whole row) | "event_type"
    decimal_columns: tuple[str, ...] = ()  # P9: DECIMAL(18,0) where present
    require_keys: tuple[str, ...] = ()  # F8: stage-1 keys that must be present
    device_keys: tuple[str, ...] = ("mac", "mac_address")
    tz: str = "UTC"
    depth: int = 4  # levels the JSON walkers unroll (speed only)
    columns: tuple[str, ...] | None = None  # stage-2 columns; None: one for every payload key
    seen_within: str | None = None  # drop what a device sent again within this time ("2 hours")
    rest_column: str | None = None  # with ``columns``: where the other keys go, as JSON

    def with_options(self, **changes) -> "Profile":
        return replace(self, **changes)


_METRICS = dict(
    family="metrics",
    payload="metrics",
    time_field="epoch_time",
    date_key="thedate",
    side_fields=("thedate",),
    partitions=("thedate",),
)
_EVENTS = dict(
    family="events",
    payload="events",
    time_field="event_time",
    date_key="event_date",
    side_fields=("event_date", "logstash_processed_at_date", "logstash_processed_at"),
    partitions=("event_date", "event_type"),
)

# Fixed values of the eight streams: names, hardware stamps, partition columns, dropped
# columns and column copies, as the device generations and families define them.
PROFILES: dict[str, Profile] = {
    "m5": Profile(
        name="kafka_to_hive_v5_metrics", hw_stamp="v5", **_METRICS,
        drops=("metrics", "hw_type"), copies=(("mac", "mac_address"),),
    ),
    "m5c": Profile(
        name="kafka_to_hive_v5c_metrics", hw_stamp="v5c", **_METRICS,
        drops=("metrics", "http_type", "hw_type"), copies=(("mac", "mac_address"),),
    ),
    "m6": Profile(
        name="kafka_to_hive_v6_metrics", hw_stamp="V6", **_METRICS,
        copies=(("mac", "mac_address"),),
    ),
    "m7": Profile(
        name="kafka_to_hive_v7_metrics", hw_stamp="v7", **_METRICS,
        copies=(("mac", "mac_address"),),
    ),
    "e5": Profile(
        name="kafka_to_hive_v5_events", hw_stamp="v5", **_EVENTS,
        drops=("HTTP_response_code", "null", "(null)", "events.*"),
        copies=(("mac", "mac_address"), ("event_type", "sub_type"), ("event_epoch_time", "event_time")),
        allow_list=DEFAULT_ALLOWED_EVENTS,
    ),
    "e5c": Profile(
        name="kafka_to_hive_v5c_events", hw_stamp="v5c", **_EVENTS,
        drops=("HTTP_response_code", "null", "(null)", "events.*"),
        copies=(("mac", "mac_address"), ("event_type", "sub_type"), ("event_epoch_time", "event_time")),
        allow_list=DEFAULT_ALLOWED_EVENTS,
    ),
    "e6": Profile(
        name="kafka_to_hive_v6_events", hw_stamp="v6", **_EVENTS,
        drops=("events", "http_type"),
        copies=(("mac", "mac_address"), ("event_type", "sub_type"),
                ("logstash_date", "event_date"), ("event_epoch_time", "event_time")),
        type_hygiene=True,
    ),
    "e7": Profile(
        name="kafka_to_hive_v7_events", hw_stamp="v7", **_EVENTS,
        drops=("events", "http_type", "hdcp_status", "last_known_heart_beat"),
        copies=(("mac", "mac_address"),),
        decimal_columns=V7_DECIMAL_COLUMNS,
        require_keys=("event_type",),
    ),
}


def profile(key: str) -> Profile:
    return PROFILES[key]
