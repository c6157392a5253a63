"""Small source folders for the tests."""

from pathlib import Path

from stratalake.schemas import RAW

CLEAN = {
    "patients": ["1,Ann,Lee,F,1980-05-01,A+,Rome,Italy,+1555,ANN@X.ORG,2020-01-01,yes",
                 "2,Bob,Ray,m,1990-06-02,O-,Oslo,Norway,+1556,bob@x.org,2021-01-01,no"],
    "doctors": ["1,Eve,Kay,Surgical,1,MD,2010-01-01,Active,+1", "2,Dan,Oak,Cardio,2,PhD,2011-01-01,On Leave,+2"],
    "departments": ["1,Surgery,Main,1st,Dr. A,1990-01-01", "2,Heart,East,2nd,Dr. B,1991-01-01"],
    "treatments": ["1,Scan,Diagnostic,icd-1,Flu,100.50,30", "2,Cast,Surgical,icd-2,Break,200,45"],
    "insurance_providers": ["1,Blue,PPO,80,1000000,Active", "2,Red,HMO,70,50000,Discontinued"],
    "appointments": ["1,1,1,1,1,2023-01-02,09:00,30,Completed,50.00,ok",
                     "2,1,2,2,2,2023-01-03,10:00,20,Scheduled,75.00,",
                     "3,2,1,1,1,2023-02-01,11:00,15,noshow,20.00,late"],
    "bills": ["1,1,1,1,1,1,2023-01-02,100.00,60.00,40.00,0.00,paid",
              "2,2,1,2,2,2,2023-01-03,80.00,10.00,20.00,50.00,partial",
              "3,3,2,1,,1,2023-02-01,30.00,0,0,30.00,pending"],
}


def write_sources(folder: Path, **changed) -> str:
    """The clean sources as CSV files, with whole tables replaced by ``changed``."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in {**CLEAN, **changed}.items():
        (folder / f"{name}.csv").write_text("\n".join([",".join(RAW[name]), *lines]) + "\n")
    return str(folder)
