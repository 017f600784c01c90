"""Tables that define which properties each version of the opportunity model asks for."""

from __future__ import annotations

# fixed values: required, recommended and optional properties by category and version
SPECS: dict[str, dict[str, dict[str, tuple[str, ...]]]] = {
    "Event": {
        "V1.0": {
            "required": ("@id", "url", "name", "location", "activity"),
            "recommended": ("description", "duration", "organizer", "contributor", "eventStatus", "category"),
            "optional": (
                "identifier", "image", "startDate", "endDate", "maximumAttendeeCapacity", "remainingAttendeeCapacity", "subEvent", "superEvent", "schedule", "ageRange",
                "genderRestriction", "programme", "attendeeInstructions", "leader", "accessibilitySupport", "accessibilityInformation", "isCoached", "level", "meetingPoint",
            ),
        },
        "V2.0": {
            "required": ("@type", "url", "name", "location", "organizer", "activity"),
            "recommended": (
                "@id", "description", "startDate", "endDate", "duration", "contributor", "maximumAttendeeCapacity", "remainingAttendeeCapacity", "eventStatus", "ageRange", "level", "offers",
            ),
            "optional": (
                "identifier", "image", "subEvent", "superEvent", "eventSchedule", "schedulingNote", "category", "genderRestriction", "programme", "attendeeInstructions", "leader",
                "accessibilitySupport", "accessibilityInformation", "isCoached", "meetingPoint", "isAccessibleForFree", "potentialAction",
            ),
        },
    },
    "FacilityUse": {
        "V2.0": {
            "required": ("@type", "@id", "url", "name", "provider", "activity", "location"),
            "recommended": ("description", "image", "event"),
            "optional": (
                "identifier", "accessibilitySupport", "accessibilityInformation", "attendeeInstructions", "category", "offers", "hoursAvailable", "individualFacilityUse", "aggregateFacilityUse",
                "potentialAction",
            ),
        },
    },
    "Slot": {
        "V2.0": {
            "required": ("@type", "facilityUse", "startDate", "duration", "remainingUses"),
            "recommended": ("@id", "offers", "maximumUses"),
            "optional": ("identifier", "endDate"),
        },
    },
    "RouteGuide": {
        "V1.0": {
            "required": ("@type", "@id", "name", "description", "activity", "distance", "startPoint"),
            "recommended": (
                "datePublished", "dateModified", "indicativeDuration", "accessibilityDescription", "gradient", "surface", "geoPath", "amenityFeature", "riskInformation", "legalAdvisory",
                "contactPoint", "isBasedOn",
            ),
            "optional": (
                "url", "author", "endPoint", "headline", "mapImage", "routeDifficulty", "category", "isLoop", "isMaintained", "image", "review", "suggestedEquipment", "segments", "segmentGroups",
            ),
        },
    },
}
# later versions that differ from an earlier one by what they add, or not at all
SPECS["Event"]["V1.1"] = SPECS["Event"]["V1.0"]
SPECS["Event"]["V2.1"] = SPECS["Event"]["V2.0"] | {"optional": (*SPECS["Event"]["V2.0"]["optional"], "routeGuide")}
SPECS["FacilityUse"]["V2.1"] = SPECS["FacilityUse"]["V2.0"]
SPECS["Slot"]["V2.1"] = SPECS["Slot"]["V2.0"]

# fixed values
CATEGORY_OF = {
    "Event": "Event", "SessionSeries": "Event", "ScheduledSession": "Event", "ScheduledSessions": "Event", "CourseInstance": "Event", "EventSeries": "Event", "HeadlineEvent": "Event",
    "OnDemandEvent": "Event", "FacilityUse": "FacilityUse", "IndividualFacilityUse": "FacilityUse", "FacilityUse/Slot": "Slot", "Slot for FacilityUse": "Slot", "Slot": "Slot",
    "RouteGuide": "RouteGuide",
}
ALTERNATIVES = {("FacilityUse", "activity"): ("facilityType",), (None, "@type"): ("type",), (None, "@id"): ("id",)}
WEIGHTS = {"required": (3, -3), "recommended": (2, -1), "optional": (1, 0)}  # present, absent
V2_ONLY = ("eventSchedule", "schedulingNote", "isAccessibleForFree", "offers", "potentialAction")
V21_ONLY = ("routeGuide",)
REQUIRED_BY_KIND = {
    "SessionSeries": ("@type", "name", "url", "location", "organizer"),
    "ScheduledSession": ("@type", "startDate"),
    "Event": ("@type", "name", "url", "activity", "location", "organizer"),
    "HeadlineEvent": ("@type", "name", "url", "activity", "location", "organizer"),
    "OnDemandEvent": ("@type", "name", "url", "activity", "organizer"),
    "CourseInstance": ("@type", "name", "url", "activity", "location", "organizer"),
    "Course": ("@type",),
    "FacilityUse": ("@type", "@id", "name", "url", "provider", "activity", "location"),
    "IndividualFacilityUse": ("@type", "name", "url", "provider", "location"),
    "Slot": ("@type", "facilityUse", "startDate", "duration", "remainingUses"),
}


def alternatives(category: str, prop: str) -> tuple[str, ...]:
    return ALTERNATIVES.get((category, prop), ()) + ALTERNATIVES.get((None, prop), ())


def versions(category: str) -> list[str]:
    return sorted(SPECS[category])


def properties(category: str, version: str) -> dict[str, str]:
    return {p: status for status, own in SPECS[category][version].items() for p in own}


def bounds(category: str, version: str) -> tuple[int, int]:
    """The least and greatest score of an item."""
    own = SPECS[category][version]
    return sum(WEIGHTS[s][1] * len(p) for s, p in own.items()), sum(WEIGHTS[s][0] * len(p) for s, p in own.items())


def resolve_version(known: list[str], wanted: str) -> str:
    """The newest that is no newer than wanted, else the oldest."""
    fit = [v for v in sorted(known) if v <= wanted]
    return fit[-1] if fit else min(known)
