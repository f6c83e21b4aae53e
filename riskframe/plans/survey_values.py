"""Fixed values of the survey: labels, codes and column lists as they occur in the data."""

# ---- fixed values ------------------------------------------------------------------------

TARGET = "HadHeartAttack"

YES_NO_COLUMNS = [
    "HadHeartAttack", "HadAngina", "HadStroke", "HadAsthma", "HadCOPD", "HadDepressiveDisorder",
    "HadKidneyDisease", "HadArthritis", "DeafOrHardOfHearing", "BlindOrVisionDifficulty",
    "DifficultyConcentrating", "DifficultyWalking", "DifficultyDressingBathing", "DifficultyErrands",
    "ChestScan", "AlcoholDrinkers", "HIVTesting", "FluVaxLast12", "PneumoVaxEver", "HighRiskLastYear",
]

GENERAL_HEALTH_LEVELS = ["Poor", "Fair", "Good", "Very good", "Excellent"]
REMOVED_TEETH_LEVELS = ["None of them", "1 to 5", "6 or more, but not all", "All"]
AGE_LEVELS = [
    "18-24", "25-29", "30-34", "35-39", "40-44", "45-49", "50-54", "55-59", "60-64", "65-69",
    "70-74", "75-79", "80 or older",
]
USE_LEVELS = ["Never", "Former", "Some days", "Every day"]

CHECKUP_RULES = [
    ("contains", "anytime less than 12 months", "Within past year"),
    ("contains", "less than 2 years", "Within past 2 years"),
    ("equals", "5 or more years ago", "Over 2 years ago"),
    ("contains", "less than 5 years", "Over 2 years ago"),
]
TETANUS_RULES = [
    ("startswith", "No, did not receive", "No"),
    ("equals", "Yes, received Tdap", "Yes-Tdap"),
    ("equals", "Yes, received tetanus shot, but not Tdap", "Yes-not Tdap"),
    ("startswith", "Yes, received tetanus shot but not sure", "Yes-type unknown"),
]
SMOKER_RULES = [
    ("equals", "Never smoked", "Never"),
    ("equals", "Former smoker", "Former"),
    ("contains", "some days", "Some days"),
    ("contains", "every day", "Every day"),
]
ECIGARETTE_RULES = [
    ("equals", "Never used e-cigarettes in my entire life", "Never"),
    ("equals", "Not at all (right now)", "Former"),
    ("equals", "Use them some days", "Some days"),
    ("equals", "Use them every day", "Every day"),
]

REGION_STATES = {
    "New_England": ["Maine", "New Hampshire", "Vermont", "Massachusetts", "Rhode Island", "Connecticut"],
    "Middle_Atlantic": ["New York", "New Jersey", "Pennsylvania"],
    "East_North_Central": ["Ohio", "Michigan", "Indiana", "Wisconsin", "Illinois"],
    "South_Atlantic": [
        "Delaware", "Maryland", "District of Columbia", "Washington, DC", "West Virginia", "Virginia",
        "North Carolina", "South Carolina", "Georgia", "Florida",
    ],
    "East_South_Central": ["Kentucky", "Tennessee", "Alabama", "Mississippi"],
    "West_South_Central": ["Arkansas", "Louisiana", "Oklahoma", "Texas"],
    "West_North_Central": [
        "Minnesota", "Iowa", "Missouri", "North Dakota", "South Dakota", "Nebraska", "Kansas",
    ],
    "Mountain": ["New Mexico", "Arizona", "Colorado", "Utah", "Nevada", "Wyoming", "Idaho", "Montana"],
    "Pacific": ["Washington", "Oregon", "California", "Alaska", "Hawaii"],
}

SCALED_COLUMNS = [
    "PhysicalHealthDays", "MentalHealthDays", "SleepHours", "HeightInMeters", "WeightInKilograms", "BMI",
    "GeneralHealth", "RemovedTeeth", "AgeCategory", "SmokerStatus_ord", "ECigaretteUsage_ord",
    "SmokerOrECig_ord",
]

# columns of the association and selection study
CONTINUOUS_COLUMNS = [
    "PhysicalHealthDays", "MentalHealthDays", "SleepHours", "HeightInMeters", "BMI", "GeneralHealth",
    "RemovedTeeth", "AgeCategory", "SmokerStatus_ord", "ECigaretteUsage_ord",
]
CATEGORICAL_COLUMNS = [
    "AlcoholDrinkers", "BlindOrVisionDifficulty", "ChestScan", "CovidPos", "DeafOrHardOfHearing",
    "DifficultyConcentrating", "DifficultyDressingBathing", "DifficultyErrands", "DifficultyWalking",
    "FluVaxLast12", "HIVTesting", "HadAngina", "HadArthritis", "HadAsthma", "HadCOPD",
    "HadDepressiveDisorder", "HadDiabetes", "HadHeartAttack", "HadKidneyDisease", "HadSkinCancer",
    "HadStroke", "HighRiskLastYear", "LastCheckupTime", "PhysicalActivities", "PneumoVaxEver",
    "RaceEthnicityCategory", "Region", "Sex", "TetanusLast10Tdap",
]
FACTOR_COLUMNS = ["CovidPos", "HadDiabetes", "RaceEthnicityCategory", "Region"]

CHECKUP_HIGH, CHECKUP_LOW = "Within past year", "Over 2 years ago"
TETANUS_HIGH, TETANUS_LOW = "Yes-Tdap", "No"

# ---- end of fixed values -----------------------------------------------------------------

STATE_TO_REGION = {state: region for region, states in REGION_STATES.items() for state in states}
