"""Fixed values of the CRM data contract.

Everything here has to equal what the CRM export and the dashboards use, so it is
stated once, as plain text, and imported from here.
"""

# Stage code of each step of the sales process.
STAGE_CODES = {
    "op": "appointmentscheduled",
    "prep": "1067388789",
    "sent": "presentationscheduled",
    "won": "closedwon",
    "lost": "closedlost",
}

# Curated column -> property of the raw object.
DEAL_PROPERTIES = {
    "deal_name": "dealname",
    "owner_id": "hubspot_owner_id",
    "deal_stage": "dealstage",
    "created_at": "createdate",
    "closed_at": "closedate",
    "last_modified_at": "hs_lastmodifieddate",
    "amount": "amount",
}
ACTIVITY_PROPERTIES = {
    "owner_id": "hubspot_owner_id",
    "created_at": "hs_createdate",
    "last_modified_at": "hs_lastmodifieddate",
}
CONTACT_PROPERTIES = {
    "owner_id": "hubspot_owner_id",
    "firstname": "firstname",
    "lastname": "lastname",
    "email": "email",
    "created_at": "createdate",
    "last_modified_at": "lastmodifieddate",
}
COMPANY_PROPERTIES = {
    "name": "name",
    "created_at": "createdate",
    "last_modified_at": "hs_lastmodifieddate",
}

# Properties of the alternate activity table, in order of precedence.
ALTERNATE_ACTIVITY_PROPERTIES = {
    "occurred_at": ["hs_timestamp", "createdate", "hs_createdate"],
    "owner_id": ["hubspot_owner_id", "hs_created_by"],
    "channel": ["hs_communications_channel", "hs_channel"],
}

# Spellings of the ends of an association result, in order of precedence.
ASSOCIATION_FROM_OBJECT = ["id", "objectId", "fromObjectId"]
ASSOCIATION_FROM = ["fromId", "fromObjectId", "id"]
ASSOCIATION_TO_OBJECT = ["id", "toObjectId", "objectId"]

# Deal time column -> step of the sales process it is the entry of.
STAGE_TIMES = {
    "op_detected_at": "op",
    "proposal_prep_at": "prep",
    "proposal_sent_at": "sent",
    "closed_won_at": "won",
    "closed_lost_at": "lost",
}

# Prefixes of the stage-entry properties, preferred one first.
STAGE_ENTRY_PREFIXES = ["hs_v2_date_entered_", "hs_date_entered_"]

# Deal source properties, in order of precedence.
DEAL_SOURCE_PROPERTIES = [
    "deal_source",
    "source",
    "lead_source",
    "hs_analytics_source",
    "hs_analytics_source_data_1",
]

# Activity object types and the activity type each one falls back to.
DEFAULT_ACTIVITY_TYPE = {
    "emails": "EMAIL",
    "calls": "CALL",
    "meetings": "MEETING",
    "tasks": "TASK",
    "notes": "NOTE",
    "communications": "NOTE",
}

# Property that carries a more specific activity type.
SPECIFIC_TYPE_PROPERTY = {
    "emails": "hs_email_direction",
    "communications": "hs_communication_channel_type",
}

# Activity types taken over from the property as they are.
SPECIFIC_ACTIVITY_TYPES = [
    "EMAIL",
    "INCOMING_EMAIL",
    "FORWARDED_EMAIL",
    "LINKEDIN_MESSAGE",
    "SMS",
    "WHATS_APP",
    "CALL",
    "MEETING",
    "TASK",
    "NOTE",
]

# Curated metadata column -> (object type, source properties by precedence).
ACTIVITY_METADATA = {
    "communication_body": ("communications", ["hs_communication_body", "hs_body_preview"]),
    "communication_source": ("communications", []),
    "task_subject": ("tasks", ["hs_task_subject"]),
    "task_body": ("tasks", ["hs_task_body"]),
    "task_status": ("tasks", ["hs_task_status"]),
    "call_title": ("calls", ["hs_call_title"]),
    "call_body": ("calls", ["hs_call_body"]),
    "call_duration": ("calls", ["hs_call_duration"]),
    "call_outcome": ("calls", ["hs_call_outcome"]),
    "meeting_title": ("meetings", ["hs_meeting_title"]),
    "meeting_body": ("meetings", ["hs_meeting_body"]),
    "meeting_outcome": ("meetings", ["hs_meeting_outcome"]),
    "email_subject": ("emails", ["hs_email_subject"]),
    "email_body": ("emails", ["hs_email_text"]),
    "email_direction": ("emails", ["hs_email_direction"]),
    "note_body": ("notes", ["hs_note_body"]),
}

# Names the associated objects of a deal are found under.
ASSOCIATED_COMPANIES = "companies"
ASSOCIATED_CONTACTS = "contacts"

# Fixed value: source recorded for every communication.
COMMUNICATION_SOURCE = "CRM_v3_Communications"

# Singular activity names of the alternate activity table.
ALTERNATE_ACTIVITY_NAMES = {
    "emails": "Email",
    "calls": "Call",
    "meetings": "Meeting",
    "tasks": "Task",
    "notes": "Note",
}

# Channel text -> name, for communications of the alternate activity table.
ALTERNATE_CHANNEL_NAMES = {
    "linkedin": "LinkedIn Message",
    "whatsapp": "WhatsApp",
    "sms": "SMS",
}
ALTERNATE_CHANNEL_DEFAULT = "Communication"

# Upper-cased activity types -> dashboard category.
CATEGORY_BY_TYPE = {
    "CALL": "Call",
    "INCOMING_EMAIL": "Email reply from contact",
    "FORWARDED_EMAIL": "Forwarded email",
    "LINKEDIN_MESSAGE": "LinkedIn Message",
    "LINKEDIN": "LinkedIn Message",
    "SMS": "SMS",
    "WHATS_APP": "WhatsApp",
    "WHATSAPP": "WhatsApp",
    "WHATS-APP": "WhatsApp",
    "WHATS APP": "WhatsApp",
    "MEETING": "Meeting",
    "TASK": "Task",
}

# The other dashboard categories.
CATEGORY_EMAIL_IN = "Email reply from contact"
CATEGORY_EMAIL_OUT = "Email sent to contact"
CATEGORY_NOTE = "Note"
CATEGORY_UNKNOWN = "Unknown"
CATEGORY_CONTACT_CREATED = "Contact created"
CATEGORY_CONTACT_WORKED = "Contact worked"
CATEGORY_DEAL_CREATED = "Deal created"

# Text searched in bodies and sources -> dashboard category.
CATEGORY_BY_TEXT = {
    "linkedin": "LinkedIn Message",
    "whatsapp": "WhatsApp",
}

# Monthly KPI rows as (sort order, label, source column, value type).
MONTHLY_KPIS = [
    (1, "Opportunities Created", "opportunities_created", "count"),
    (2, "Proposals Sent", "proposals_sent", "count"),
    (3, "Deals Closed (Won)", "closed_won", "count"),
    (4, "Avg Days Op Detected → Proposal Prep", "avg_op_to_prep_days", "avg_days"),
    (5, "Avg Days Proposal Prep → Proposal Sent", "avg_prep_to_sent_days", "avg_days"),
    (6, "Avg Days Proposal Sent → Won", "avg_sent_to_won_days", "avg_days"),
    (7, "Sales Cycle Avg (Create → Won)", "avg_sales_cycle_days", "avg_days"),
]

# The weekly KPI rows are the three counts of the monthly ones.
WEEKLY_KPIS = MONTHLY_KPIS[:3]

# Fixed value: row label of the cohort matrix.
COHORT_LABEL_PREFIX = "Deals created in "

# Quality classes of a deal's close.
QUALITY_NO_TRANSITION = "has_close_date_no_stage_transition"
QUALITY_WON = "properly_closed_won"
QUALITY_LOST = "properly_closed_lost"
QUALITY_UNKNOWN = "closed_unknown_outcome"
QUALITY_OPEN = "open"

# Fixed value: name of an owner without first and last name.
UNNAMED_OWNER = "Unknown"
