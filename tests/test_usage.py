"""The README's usage example runs as written on a small set of files."""

import os
import re

from strata.session import scratch_path

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")

SPENDING = ("Gemeinde,Year,Abschnitt,Betrag\nSt. Florian,2013,Sport,100.5\nSt. Florian,2013,Summe,100.5\n"
            'St. Florian,2013,"Unterricht, Erziehung, Sport und Wissenschaft",40\n'
            "Linz,2017,Sport,7\nLinz,2017,Summe,70\nWels,2017,Sport,9\n")
VOTES = {
    "2013": 'Nr.,Name,Wahlberechtigte,abgegeb. Stimmen,gültige,ungültige,Wahlbet.,A,B\n'
            '40101,St. Florian,10,8,8,0,"80,0",5,3\n',
    "2017": 'Nr.,Name,Wahlberechtigte,abgegeb. Stimmen,gültige,ungültige,Wahlbet.,A,C\n'
            '40102,Linz,10,7,7,0,"70,0",1,6\n40103,Wels,10,6,6,0,"60,0",4,4\nSumme,Alle,20,15,15,0,"75,0",6,9\n',
}
NATION = "YEAR;LAU2_NAME;A;T\n2011;St. Florian;9;10\n2016;Linz;5;10\n"


def test_readme_example(spark):
    root = scratch_path(spark, "usage")
    os.makedirs(root)
    with open(f"{root}/spending.csv", "w", encoding="utf-8") as f:
        f.write(SPENDING)
    for y, text in VOTES.items():
        os.makedirs(f"{root}/votes/{y}")
        with open(f"{root}/votes/{y}/v.csv", "w", encoding="latin-1") as f:
            f.write(text)
    with open(f"{root}/nation.csv", "w", encoding="latin-1") as f:
        f.write(NATION)
    code = open(README, encoding="utf-8").read().split("## Using it on your own panel files")[1]
    code = re.search(r"```python\n(.*?)```", code, re.S).group(1)
    # relative paths resolve against the JVM's working folder: point them at the fixture
    code = re.sub(r'"((?:spending|nation)\.csv|merged/|votes/\d{4})"', lambda m: f'"{root}/{m.group(1)}"', code)
    ns = {"spark": spark}
    exec(code, ns)  # noqa: S102 - the documented example itself
    got = {(r.entity, r.Year): (r.Winning_Party, r.Spending_Summe, r.nation_period)
           for r in ns["merged"].collect()}
    assert got == {("st.-florian", 2013): ("A", 140.5, 2011), ("linz", 2017): ("C", 7.0, 2016),
                   ("wels", 2017): ("A", 9.0, None)}
    assert sorted(ns["parties"]) == ["A", "B", "C"]
    assert {r.band for r in ns["shares"].collect()} == {"Near Mean"}
