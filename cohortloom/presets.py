"""A ready descriptor for the public lung-cancer risk sheet (25 columns)."""

from cohortloom.schema import CohortSchema

# The sheet's own headers (irregular capitals included) and the
# snake_case name each one gets.
PATIENT_RENAMES = {
    "Patient Id": "patient_id",
    "Age": "age",
    "Gender": "gender",
    "Air Pollution": "air_pollution",
    "Alcohol use": "alcohol_use",
    "Dust Allergy": "dust_allergy",
    "OccuPational Hazards": "occupational_hazards",
    "Genetic Risk": "genetic_risk",
    "chronic Lung Disease": "chronic_lung_disease",
    "Balanced Diet": "balanced_diet",
    "Obesity": "obesity",
    "Smoking": "smoking",
    "Passive Smoker": "passive_smoker",
    "Chest Pain": "chest_pain",
    "Coughing of Blood": "coughing_of_blood",
    "Fatigue": "fatigue",
    "Weight Loss": "weight_loss",
    "Shortness of Breath": "shortness_of_breath",
    "Wheezing": "wheezing",
    "Swallowing Difficulty": "swallowing_difficulty",
    "Clubbing of Finger Nails": "clubbing_of_finger_nails",
    "Frequent Cold": "frequent_cold",
    "Dry Cough": "dry_cough",
    "Snoring": "snoring",
    "Level": "level",
}

# Labels, category names, bucket names and chart indicators.
PATIENTS = CohortSchema(
    id="patient_id",
    label="level",
    labels=("Low", "Medium", "High"),
    number="age",
    category="gender",
    codes={1: "Nam", 2: "Nữ"},
    other="Khác",
    ordinals=tuple(
        name
        for name in PATIENT_RENAMES.values()
        if name not in ("patient_id", "age", "gender", "level")
    ),
    buckets=((3, "thap"), (6, "trungbinh"), (None, "cao")),
    chart=("smoking", "coughing_of_blood", "obesity", "alcohol_use", "genetic_risk"),
)
