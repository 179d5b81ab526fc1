"""Names, labels, positions and patterns that are part of the data
model. They have to be exactly these for results to be right, so they are kept
together here as plain text.
"""

# --- input schemas (DDL) ------------------------------------------------------

TICKET_DDL = """
    InitialStartDateTime string, TicketId string, CalledNumber string,
    CallingNumber string, CallType string, EffectiveCallDuration string,
    InitialDialledNumber string, StartDateTime string, InternFacilities string,
    ChargedNumber string, CostCenter string, WaitingDuration string
"""

# Phone numbers stay strings: as integers they would lose their leading zeros.
IVR_CALL_DDL = """
    id string, caller string, called string, tenantid string, tenantname string,
    treeid string, treename string, start double, started timestamp,
    duration double, blockread int, endcause string, gcid string, cdin string,
    cdout string, transferredto string, forwardednumber string,
    reinvitednumber string, nodeid_used string
"""

IVR_BLOCK_DDL = """
    id string, event string, timestamp double, createdate timestamp,
    `duration (ms)` int, `bloc id` string, `bloc name` string
"""

IVR_CALL_REQUIRED = [
    "id", "caller", "called", "tenantname", "treename", "start", "duration",
    "endcause", "transferredto",
]

IVR_BLOCK_REQUIRED = [
    "id", "duration (ms)", "bloc id", "bloc name", "timestamp", "event", "createdate",
]

# --- positions of the one-character flags in InternFacilities, 1-based ----------

FACILITY_POSITIONS = {
    "CallForwardingUnconditional": 6,
    "CallForwardingOnBusy": 7,
    "CallForwardingOnNoReply": 8,
    "Transfer": 9,
    "BasicCall": 23,
    "OperatorFacility": 24,
    "Substitution": 24,
    "PriorityIncomingCall": 26,
    "Transit": 27,
    "PrivateOverflowToPublic": 28,
    "ReroutingPublicToPrivate": 29,
    "FaxServer": 30,
    "VoiceMail": 32,
    "CentralAbbreviatedNumberring": 32,
    "IntegratedServiceVPN": 34,
    "OverflowVPN": 35,
    "ARSService": 36,
    "Disa": 37,
}

# --- patterns -----------------------------------------------------------------

OFFICE_CODE_PATTERN = r"\W(\d\w{5,7})"
SIP_USER_PATTERN = r"sip:(.*)\@.*"
TRANSFER_BLOCK_MARK = "transfer_"
TITLE_LINE_TYPE = "CTURE"
NO_END_OF_VALIDITY = "99999999"

# --- call types, end causes and labels --------------------------------------------

EMITTED_CALL_TYPES = [0, 3, 7, 8]
RECEIVED_CALL_TYPES = [4, 9, 13]
FIRST_LEG_CALL_TYPE = 4
IVR_CALL_TYPE = 9
INTERNAL_CALL_TYPE = 14

TRANSFERRED = "TRANSFERRED"
RELEASED_BY_CALLER = "RELEASED By Caller"
RELEASED_BY_IVR = "RELEASED By VAA"
NO_LICENSE = "NOT ENOUGH LICENSE"

EMITTED = "Appel émis"
RECEIVED = "Appel reçu"
UNKNOWN = "Inconnu"
EXTERNAL = "Externe"
INTERNAL = "Interne"

ORIGIN_IVR = "SVI"
ORIGIN_IVR_UNKNOWN = "SVI non reconnu"
ORIGIN_DIRECT = "Direct"
INCOMING_EXTERNAL = "Appel entrant direct externe"
INCOMING_INTERNAL = "Appel entrant direct interne"

OUTCOME_NOT_ANSWERED = "Appel non décroché"
OUTCOME_DETERRED = "Appel dissuadé"
OUTCOME_HUNG_UP = "Appel raccroché"
OUTCOME_ANSWERED = "Appel décroché"
OUTCOME_V1_IVR = "Le SVI raccroche"
OUTCOME_V1_CALLER = "L'appelant raccroche"
OUTCOME_V1_CONNECTED = "Mise en relation"

OPENING_HOURS = "Horaire d’ouverture"
CLOSING_HOURS = "Horaire de fermeture"

IN_PLAN = "Forfait"
OUT_OF_PLAN = "Hors forfait"
TO_SPECIAL = "Numéros spéciaux"
TO_NATIONAL = "National"
TO_SHORT = "N° courts"
TO_INTERNAL = "Numéros internes"
TO_EMERGENCY = "Numéros d'urgence"
TO_INTERNATIONAL = "International"
TO_INTERNAL_V1 = "N° courts (urgence)"
TO_EMERGENCY_V1 = "N° courts (services)"
TO_OTHER_SHORT_V1 = "N° courts (autre)"
EMERGENCY_NUMBERS = ["15", "17", "18"]

FRENCH_WEEKDAYS = [  # by dayofweek(), Sunday = 1
    "dimanche", "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi",
]
QUARTERS = ["00-15", "15-30", "30-45", "45-00"]

# --- column lists -----------------------------------------------------------------

RULE_COLUMNS = [
    "InitialStartDateTime", "TicketId", "CalledNumber", "CallingNumber", "CallType",
    "WaitingDuration", "EffectiveCallDuration", "StartDateTime", "ChargedNumber", "id",
    "duration", "endcause", "transferredto", "bloc_name", "bloc_duration", "Motif_appel",
    "SAGES", "CallForwardingUnconditional", "CallForwardingOnBusy",
    "CallForwardingOnNoReply", "Appel_transfere", "VoiceMail", "Type_appel",
    "calledNumber_externe_interne", "Origine", "Origine_appel_entrant", "Appels_emis",
    "Appels_recus", "Appels", "Mise_en_relation", "Appels_SVI", "Appels_dissuades",
    "Appels_raccroches", "Appels_sans_license", "Appels_SVI_non_reconnu",
    "Appels_directs_internes", "Appels_directs_externes", "Appels_aboutis",
    "Appels_decroches", "Appels_non_decroches", "Appels_transferes", "Appels_renvoyes",
    "Attente_avant_mise_en_relation", "Duree_de_navigation", "Duree_de_communication",
    "postes_logges", "Aboutissement_SVI", "Horaire_ouverture",
]

TARIFF_COLUMNS = RULE_COLUMNS + [
    "Indicatif_numero", "Pays", "Appel_facturable", "Appel_vers",
]

CROSS_REFERENCE_COLUMNS = [
    "InitialStartDateTime", "id", "TicketId", "CalledNumber", "CallingNumber", "CallType",
    "ChargedNumber", "transferredto", "Motif_appel", "SAGES", "Type_appel",
    "calledNumber_externe_interne", "Origine", "Origine_appel_entrant", "Appels_emis",
    "Appels_recus", "Appels", "Mise_en_relation", "Appels_SVI", "Appels_dissuades",
    "Appels_raccroches", "Appels_SVI_non_reconnu", "Appels_directs_internes",
    "Appels_directs_externes", "Appels_aboutis", "Appels_decroches",
    "Appels_non_decroches", "Appels_transferes", "Appels_renvoyes",
    "Attente_avant_mise_en_relation", "Duree_de_navigation", "Duree_de_communication",
    "postes_logges", "Aboutissement_SVI", "Appel_facturable", "Appel_vers", "Pays",
]

ORGANISATION_COLUMNS = [
    "Code_UA", "Code_type_de_structure", "Etat", "Date_deffet_de_letat",
    "DIR_hierarchique", "CI_hierarchique", "CB_hierarchique", "Libelle_court_1",
    "Libelle_court_2", "Libelle_long_2", "Libelle_long_1",
]
VALIDITY_COLUMN = "Date_limite_de_validite"
ORGANISATION_RENAMES = {
    "Libelle_long_1": "Bureau",
    "Libelle_long_2": "Bureau_2",
    "Libelle_court_1": "Bureau_court",
}

EXPORT_COLUMNS = [  # (column of the fact table, name in the export)
    ("InitialStartDateTime", "InitialStartDateTime"),
    ("CalledNumber", "CalledNumber"),
    ("CallingNumber", "CallingNumber"),
    ("ChargedNumber", "ChargedNumber"),
    ("transferredto", "transferredto"),
    ("Motif_appel", "Motif_appel"),
    ("Type_appel", "Type_appel"),
    ("calledNumber_externe_interne", "CalledNumber_externe_interne"),
    ("Origine", "Origine"),
    ("Origine_appel_entrant", "Origine_appel_entrant"),
    ("Appels_emis", "Appels_emis"),
    ("Appels_recus", "Appels_recus"),
    ("Appels", "Appels_reiteres"),
    ("Mise_en_relation", "Mises_en_relation"),
    ("Appels_SVI", "Appels_SVI"),
    ("Appels_dissuades", "Appels_dissuades"),
    ("Appels_raccroches", "Appels_raccroches"),
    ("Appels_SVI_non_reconnu", "Appels_SVI_non_reconnu"),
    ("Appels_directs_internes", "Appels_directs_internes"),
    ("Appels_directs_externes", "Appels_directs_externes"),
    ("Appels_aboutis", "Appels_aboutis"),
    ("Appels_decroches", "Appels_decroches"),
    ("Appels_non_decroches", "Appels_non_decroches"),
    ("Appels_transferes", "Appels_transferes"),
    ("Appels_renvoyes", "Appels_renvoyes"),
    ("Attente_avant_mise_en_relation", "Attente_avant_mise_en_relation"),
    ("Duree_de_navigation", "Duree_de_navigation_SVI"),
    ("Duree_de_communication", "Duree_de_communication"),
    ("postes_logges", "postes_logges"),
    ("Aboutissement_SVI", "Aboutissement_SVI"),
    ("Appel_facturable", "Appel_facturable"),
    ("Appel_vers", "Appel_vers"),
    ("Pays", "Pays"),
    ("SAGES", "SAGES"),
    ("dayofweek", "Day_of_week"),
    ("Hour", "Hour"),
    ("Date", "Date"),
    ("Service", "Service"),
    ("quarter", "Quarter_of_hour"),
    ("Lib_hour", "Lib_hour"),
]

# Columns of the matched calls and of their legs.
TICKET_COLUMNS = [
    "InitialStartDateTime", "StartDateTime", "TicketId", "CalledNumber", "InternFacilities",
    "CallType", "ChargedNumber", "EffectiveCallDuration", "CostCenter", "CallingNumber",
    "WaitingDuration",
]
MATCH_COLUMNS = ["started_datetime", "temp_caller", "endcause", "date_diff"]
DETAIL_COLUMNS = [
    "id", "bloc duration", "bloc name", "Motif appel", "bloc id", "caller", "called",
    "tenantname", "treename", "start", "duration", "transferredto", "SAGES (bloc)",
]
MATCH_RENAMES = {
    "SAGES (bloc)": "SAGES",
    "bloc name": "bloc_name",
    "bloc duration": "bloc_duration",
    "bloc id": "bloc_id",
    "Motif appel": "Motif_appel",
}
USED_FLAGS = [
    "CallForwardingUnconditional", "CallForwardingOnBusy", "CallForwardingOnNoReply",
    "VoiceMail", "Transfer",
]
LEG_COLUMNS = [
    "InitialStartDateTime", "TicketId", "CalledNumber", "CallingNumber", "CallType",
    "WaitingDuration", "EffectiveCallDuration", "StartDateTime", "ChargedNumber", "id",
    "duration", "endcause", "transferredto", "bloc_name", "bloc_duration", "Motif_appel",
    "SAGES", "CallForwardingUnconditional", "CallForwardingOnBusy",
    "CallForwardingOnNoReply", "VoiceMail", "Appel_transfere", "Type_appel",
    "calledNumber_externe_interne",
]
