"""Input shapes as DDL text: stream envelopes, and the wide path list of a learning event."""

from __future__ import annotations

ENVELOPE = (
    "eventSource string, eventVersion string, eventID string, eventName string, invokeIdentityArn string, "
    "awsRegion string, eventSourceARN string, kinesisSchemaVersion string, partitionKey string, "
    "sequenceNumber string, data string, approximateArrivalTimestamp double"
)

NESTED_ENVELOPE = (
    "Records array<struct<kinesis struct<partitionKey string, kinesisSchemaVersion string, data string, "
    "sequenceNumber string, approximateArrivalTimestamp double>, eventSource string, eventID string, "
    "eventVersion string, eventName string, eventSourceARN string, awsRegion string>>"
)

QUEUE_MESSAGE = "messageId string, receiptHandle string, body string"

DLQ_BODY = (
    "requestContext struct<condition string>, KinesisBatchInfo struct<shardId string, "
    "startSequenceNumber string, endSequenceNumber string, approximateArrivalOfFirstRecord string, "
    "batchSize int, streamArn string>"
)

# Verbs, extension keys and event types.
VERB_PREFIX = "http://adlnet.gov/expapi/verbs/"
RAW_TABLE_VERBS = ("initialized", "answered", "attempted", "completed", "terminated", "experienced")
STREAM_VERBS = ("answered", "experienced", "attempted", "terminated")
ACT_TYPE = "http://act_type"
IDS = "http://ids"
SCORM = "http://scorm&46;com/extensions/usa-data"
READING_TYPES = ("acceso", "callback")

# Entity keys with a projection, and those dropped on arrival.
ENTITIES = (
    "SCHOOLCLASS", "SCHOOLGRADEGROUP", "SCHOOLLEVELSESSION", "SESSION", "SUBJECTSCHOOLCLASS", "UNOSCHOOL", "USER",
    "USERGROUP", "USERROLE", "USERSCHOOLCLASS",
)
IGNORED_ENTITIES = (
    "ARTICLE", "CONTENTSCHOOLCLASS", "CONTENTSCHOOLLEVELSESSION", "CONTACTRELATIONSHIP", "SCHOOLIMAGE",
    "USERARTICLENOTIFICATION", "USERARTICLEROLE", "USERIMAGE",
)

# Paths of the wide event row. Groups share a prefix; "" is the whole document.
_WIDE_PATHS = {
    "": """id active voided date_insert ttl lrs_id client_id activityID verbID relatedAgents relatedActivities""",
    "statement.": """id timestamp stored actor.name actor.mbox actor.objectType verb.id verb.display verb.display.und
        verb.display.en-US verb.display.en-GB verb.display.es verb.display.es-ES verb.display.de-DE
        verb.display.fr-FR authority.name authority.mbox""",
    "statement.result.": """success response completion duration score.raw score.min score.max score.scaled
        extensions""",
    f"statement.result.extensions.`{SCORM}`.": """analytics multipleRecording correctResponsesPattern response""",
    "statement.object.": """id objectType definition definition.name definition.description definition.description.es
        definition.type definition.interactionType definition.correctResponsesPattern definition.source
        definition.target definition.extensions""",
    f"statement.object.definition.extensions.`{ACT_TYPE}`": """. activityRefId resourceId resourceRefId sourceRefId
        inApp learningUnitRefId schoolClassId learningObjectiveRefId typeActivityIntelligence pageRefId levelCode
        adventureCode schoolRefId infoUserAgent sectionSubjectRefId pageId descriptionPeriod idPeriod studentRefId
        rolId learningLevelRefId typeActivityValue act_type unitid learningObjectiveRefIdAPI infoLocation
        subjectGradeRefId achievementCode""",
    f"statement.object.definition.extensions.`{IDS}`": """. infoUserAgent resourceId resourceRefId sourceRefId inApp
        learningUnitRefId sectionSubjectRefId schoolClassId pageId pageRefId studentRefId rolId adventureCode unitId
        infoLocation subjectGradeRefId schoolRefId""",
    "statement.context": """. contextActivities contextActivities.parent contextActivities.parent[0].id
        contextActivities.parent[0].objectType""",
}


def wide_paths() -> list[str]:
    """Dotted paths of the wide event row, ending with "" (the whole document)."""
    paths = []
    for prefix, names in _WIDE_PATHS.items():
        joiner = "" if prefix == "" or prefix.endswith(".") else "."
        for name in names.split():
            paths.append(prefix if name == "." else f"{prefix}{joiner}{name}")
    return paths + [""]
