"""Codes, names and dates that decide results. Plain data, in natural order."""

import datetime as dt

# Management types
SHIP_MANAGEMENT = ["Full Management", "Tech Mgmt"]
CREW_AND_SHIP_MANAGEMENT = ["Tech Mgmt", "Full Management", "Crew Mgmt"]

# Crew
TRANSFER_EVENT = "Management Transfer"
OWNER_SUPPLIED_CONTRACT = "VSHP00000002"
RATINGS = ["Ratings", "Offshore Ratings"]
OFF_VESSEL_STATUSES = ["OB", "OV"]

# Mobilisation cells, by id
RETIRED_INDIA_CELLS = ["VGRP00000105", "GLAX00000023", "GLAX00000010", "GLAX00000005"]
AGENCY_CELLS = ["VGRP00000117", "VGRP00000118", "VGR300000031", "VGR400000265"]
LEISURE_CELLS = ["VGR400000193", "VGR700000357"]
CELLS_NOT_SCORED = [
    "VGR400000297", "VGRP00000105", "GLAX00000023", "GLAX00000010", "GLAX00000005", "VGR700000390", "VGR700000376",
]
EUROPE_PLANNING_CELLS = ["MIGI00000082", "VGR400000201", "MIGI00000039"]
CANADIAN_EXEMPT_CELL = "VGRP00000130"
MOBILISATION_POOL_TYPE, RECRUITMENT_POOL_TYPE = 1, 6

# Mobilisation cells, by name
CELL_NAMES_NOT_ONBOARD = ["IND_F3_MOBILISE", "IND_RECRUITMENT", "IND_F9_MOBLISE", "IND_F4_MOBILISE"]
CELL_NAMES_WITHOUT_TRAINING = ["TPA_Aboitiz_Jebsen", "TPA_DGS", "TPA_Uniteam", "TPA_Uniteam_NRS_fleet_Mob"]

# Training needs
TRAINING_FLOOR = dt.date(2023, 1, 1)

# Document uploads
FLAG_COUNTRIES = [
    "Azerbaijan", "Bahamas", "Belgium", "Belize", "Cayman Islands", "Cyprus", "DANISH INTERNATIONAL REGISTER",
    "Gibraltar", "Hong Kong", "Isle Of Man.", "Liberia", "LUXEMBOURG (UN)", "Madeira", "Malta", "Marshall Islands",
    "Nigeria", "Norwegian International ShipRegister", "Panama", "Singapore", "St. Vincent",
]
CREW_VISA = "Visa - MCV"

# Checklists, reliability, acceptance, debriefing
CHECKLIST_STATUSES = ["GLAS00000002", "GLAS00000003"]
CLIENTS_WITHOUT_CHECKLIST = ["ADNOC Logistics & Services", "ADNOC Logistics and Services"]
VESSELS_NOT_RELIABILITY = ["GLAX00012386", "GLAT00000027"]
ACCEPTANCE_BUSINESS = ["Cargo", "Passenger/Ferry"]
SIGN_OFFS_NOT_DEBRIEFED = [
    "Promotion", "Transfer", "Demotion", "Vessel Change Owner", "Vessel Left Management", "Vessel Name Change",
]

# Appraisals and berths
CELL_CHANGE_EVENT = "GLAS00000003"
BUDGETED_BERTH = "VSHP00000001"

# Declared policy
POLICY_VESSEL_RANK_VESSELS = ["VGR400021519", "VGR400021518", "VGR400021295"]
POLICY_VESSEL_RANK_RANKS = ["VSHP00000349", "VGR400000680", "VSHP00000343"]
POLICY_EXEMPT_OFFICE = "CSL Australia"
POLICY_EXEMPT_AGENTS = ["VGR500006541", "VGR500006565", "VGR500006562"]
POLICY_EXEMPT_VESSELS = ["ODES00001763", "GLAT00000027", "VGRP00018812"]
POLICY_DAYS = 70

# Group switches
HISTORY_START = dt.date(2017, 1, 1)
MERGED_CLIENTS = [
    "GLAS00067713", "SING00000040", "ITMD00031533", "GLAS00000258", "ITMD00031534", "ITMD00031616", "GLAS00069495",
]
MERGED_CLIENT_ID, MERGED_CLIENT = "MIGI00001881", "Frontline Management AS"

# Recruitment
TRACKING_DONE = 11
UNKNOWN_GROUP = "UNKNOWN"
