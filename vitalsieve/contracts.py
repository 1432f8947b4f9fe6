"""Table contracts: what a raw table must look like and how each column is treated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class FieldRule:
    """How one request field is validated.

    ``codes`` maps accepted folded texts to numbers; numbers equal to a code value pass too. Without codes the field is
    a plain number, optionally in (``above``, ``at_most``]. A ``text`` field takes any single value as a level. A ``nullable`` one
    may be null, which preparation fills.
    """

    name: str
    codes: Mapping[str, int] | None = None
    above: float | None = None
    at_most: float | None = None
    allow_boolean: bool = False
    style: str = "plain"
    text: bool = False
    nullable: bool = False


@dataclass(frozen=True)
class TableContract:
    name: str
    target: str
    target_codes: Mapping[object, int]
    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    flags: Sequence[str] = ()
    order: Sequence[str] | None = None
    labels: Mapping[int, str] = field(default_factory=lambda: {0: "negative", 1: "positive"})
    row_id: str | None = "row_id"
    row_id_is_data: bool = False
    group: str | None = None
    group_from: str | None = None
    dropped: Sequence[str] = ()
    zero_means_missing: Sequence[str] = ()
    valid_zero: Sequence[str] = ()
    null_tokens: Sequence[str] = ()
    codes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    scaled: Sequence[str] | None = None
    normalise: bool = False
    drop_duplicates: bool = True
    keep_only_known_targets: bool = False
    nulls_allowed: bool = True
    rules: Sequence[FieldRule] = ()
    grouped_requests: bool = False
    lists_missing: bool = False
    refuses_extra: bool = True
    model_first: bool = False
    tiers: str | None = None
    threshold: float = 0.5
    model_name: str = "Logistic Regression"

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.order) if self.order else (*self.numeric, *self.categorical, *self.flags)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.features, self.target)

    @property
    def scaled_columns(self) -> tuple[str, ...]:
        return tuple(self.numeric if self.scaled is None else self.scaled)


# Column lists, classes, codes and null texts of the seven screening tables and the liver table.

NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

HEART = TableContract(
    name="heart",
    target="Heart Disease",
    target_codes={"Absence": 0, "Presence": 1},
    numeric=("Age", "BP", "Cholesterol", "Max HR", "ST depression"),
    categorical=(
        "Sex", "Chest pain type", "FBS over 120", "EKG results", "Exercise angina", "Slope of ST",
        "Number of vessels fluro", "Thallium",
    ),
    types={
        "Age": "int", "Sex": "int", "Chest pain type": "int", "BP": "int", "Cholesterol": "int", "FBS over 120": "int",
        "EKG results": "int", "Max HR": "int", "Exercise angina": "int", "ST depression": "double", "Slope of ST": "int",
        "Number of vessels fluro": "int", "Thallium": "int",
    },
)

DIABETES = TableContract(
    name="diabetes",
    target="Outcome",
    target_codes={0: 0, 1: 1},
    numeric=(
        "Pregnancies", "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI", "DiabetesPedigreeFunction", "Age",
    ),
    zero_means_missing=("Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"),
    valid_zero=("Pregnancies", "Outcome"),
    model_name="Random Forest",
)

STROKE = TableContract(
    name="stroke",
    target="stroke",
    target_codes={0: 0, 1: 1},
    numeric=("age", "hypertension", "heart_disease", "avg_glucose_level", "bmi"),
    categorical=("gender", "ever_married", "work_type", "Residence_type", "smoking_status"),
    row_id="id",
    row_id_is_data=True,
    null_tokens=NULL_TEXTS,
    types={"age": "double", "avg_glucose_level": "double", "bmi": "double"},
    model_name="SVM",
)

ASTHMA = TableContract(
    name="asthma",
    target="Has_Asthma",
    target_codes={0: 0, 1: 1},
    numeric=(
        "Age", "BMI", "Family_History", "Medication_Adherence", "Number_of_ER_Visits", "Peak_Expiratory_Flow", "FeNO_Level",
    ),
    categorical=(
        "Gender", "Smoking_Status", "Allergies", "Air_Pollution_Level", "Physical_Activity_Level", "Occupation_Type",
        "Comorbidities",
    ),
    labels={0: "No asthma", 1: "Has asthma"},
    row_id="Patient_ID",
    row_id_is_data=True,
    dropped=("Asthma_Control_Level",),
    null_tokens=NULL_TEXTS,
    keep_only_known_targets=True,
    model_name="gradient_boosting",
)

PARKINSONS = TableContract(
    name="parkinsons",
    target="status",
    target_codes={0: 0, 1: 1},
    numeric=(
        "MDVP:Fo(Hz)", "MDVP:Fhi(Hz)", "MDVP:Flo(Hz)", "MDVP:Jitter(%)", "MDVP:Jitter(Abs)", "MDVP:RAP", "MDVP:PPQ",
        "Jitter:DDP", "MDVP:Shimmer", "MDVP:Shimmer(dB)", "Shimmer:APQ3", "Shimmer:APQ5", "MDVP:APQ", "Shimmer:DDA",
        "NHR", "HNR", "RPDE", "DFA", "spread1", "spread2", "D2", "PPE",
    ),
    labels={0: "Healthy", 1: "Parkinson's disease screening positive"},
    row_id="name",
    row_id_is_data=True,
    group="subject_id",
    group_from="name",
    keep_only_known_targets=True,
    model_name="logistic_regression",
)

_MEASURES = (
    "radius", "texture", "perimeter", "area", "smoothness", "compactness", "concavity", "concave points", "symmetry",
    "fractal_dimension",
)
BREAST_FEATURES = tuple(f"{m}_{part}" for part in ("mean", "se", "worst") for m in _MEASURES)
BREAST_GROUPS = {"mean_features": (1, 10), "se_features": (11, 10), "worst_features": (21, 10)}

BREAST = TableContract(
    name="breast_cancer",
    target="diagnosis",
    target_codes={"B": 0, "M": 1},
    numeric=BREAST_FEATURES,
    labels={0: "Benign", 1: "Malignant"},
    row_id="id",
    row_id_is_data=True,
    dropped=("Unnamed: 32",),
    drop_duplicates=False,
    nulls_allowed=False,
    rules=tuple(FieldRule(f, allow_boolean=True) for f in BREAST_FEATURES),
    grouped_requests=True,
)

SURVEY_FLAGS = (
    "smoking", "yellow_fingers", "anxiety", "peer_pressure", "chronic_disease", "fatigue", "allergy", "wheezing",
    "alcohol_consuming", "coughing", "shortness_of_breath", "swallowing_difficulty", "chest_pain",
)
GENDER_CODES = {"FEMALE": 0, "MALE": 1}
YES_NO_CODES = {"NO": 0, "YES": 1}
DIGIT_CODES = {"0": 0, "1": 1}

LUNG = TableContract(
    name="lung_cancer",
    target="lung_cancer",
    target_codes=YES_NO_CODES,
    numeric=("age",),
    flags=("gender", *SURVEY_FLAGS),
    order=("gender", "age", *SURVEY_FLAGS),
    labels={0: "NO", 1: "YES"},
    codes={"gender": GENDER_CODES | DIGIT_CODES},
    types={"age": "double"} | {c: "int" for c in SURVEY_FLAGS},
    normalise=True,
    drop_duplicates=False,
    nulls_allowed=False,
    rules=(
        FieldRule("gender", codes=GENDER_CODES | DIGIT_CODES, style="gender"),
        FieldRule("age", above=0.0, at_most=120.0, style="age"),
        *(FieldRule(c, codes=YES_NO_CODES | DIGIT_CODES, style="flag") for c in SURVEY_FLAGS),
    ),
    model_name="LogisticRegression",
)

LIVER = TableContract(
    name="liver",
    target="Dataset",
    target_codes={1: 1, 2: 0},
    numeric=(
        "Age", "Total_Bilirubin", "Direct_Bilirubin", "Alkaline_Phosphotase", "Alamine_Aminotransferase",
        "Aspartate_Aminotransferase", "Total_Protiens", "Albumin", "Albumin_and_Globulin_Ratio",
    ),
    categorical=("Gender",),
)



# The order in which these requests' missing fields are told.

REQUEST_ORDER = {
    "heart": tuple(HEART.types),
    "stroke": (
        "gender", "age", "hypertension", "heart_disease", "ever_married", "work_type", "Residence_type", "avg_glucose_level",
        "bmi", "smoking_status",
    ),
    "asthma": (
        "Age", "Gender", "BMI", "Smoking_Status", "Family_History", "Allergies", "Air_Pollution_Level",
        "Physical_Activity_Level", "Occupation_Type", "Comorbidities", "Medication_Adherence", "Number_of_ER_Visits",
        "Peak_Expiratory_Flow", "FeNO_Level",
    ),
}


def _screened(contract: TableContract, tiers: str) -> TableContract:
    """Requests as the pipelines of these tables take them: numbers and levels, nulls filled, other fields ignored, all missing ones told."""
    texts = set(contract.categorical)
    order = REQUEST_ORDER.get(contract.name, contract.features)
    rules = tuple(FieldRule(f, allow_boolean=True, text=f in texts, nullable=True) for f in order)
    return replace(contract, rules=rules, lists_missing=True, refuses_extra=False, model_first=True, tiers=tiers)


HEART, DIABETES, STROKE = (_screened(c, "risk") for c in (HEART, DIABETES, STROKE))
ASTHMA, PARKINSONS = (_screened(c, "signal") for c in (ASTHMA, PARKINSONS))

CONTRACTS = {c.name: c for c in (HEART, DIABETES, STROKE, ASTHMA, PARKINSONS, BREAST, LUNG, LIVER)}
