"""Base forms of words that are not in the closed vocabulary, against forms written by hand."""

from pyspark.sql import functions as F

from posofold.functions.lemma import base_form, base_forms

FORMS = """
tablets tablet|capsules capsule|patches patch|doses dose|boxes box|dishes dish|pessaries pessary|allergies allergy|eyes eye
nostrils nostril|creams cream|gummies gummy|lollies lolly|wafers wafer|inhalers inhaler|syringes syringe|ounces ounce|classes class
potatoes potato|glasses glass|lunches lunch|weeks week|hours hour|keys key|days day|nurses nurse|sponges sponge
swallowed swallow|dissolved dissolve|applied apply|instilled instill|injected inject|inserted insert|inhaled inhale|mixed mix
chewing chew|taking take|using use|applying apply|dissolving dissolve|stirring stir|rubbing rub|rubbed rub|dabbed dab|dabbing dab
sucked suck|placed place|placing place|repeated repeat|repeating repeat|waited wait|required require|requiring require
prescribed prescribe|directed direct|needed need|needing need|spread spread|massaged massage|massaging massage|sprayed spray
swallowing swallow|mixing mix|eating eat|drinking drink|sleeping sleep|waking wake|stopped stop|stopping stop|limited limit|limiting limit
crushed crush|crushing crush|diluted dilute|diluting dilute|rinsed rinse|rinsing rinse|measured measure|measuring measure|poured pour
taken take|given give|eaten eat|slept sleep|teeth tooth|feet foot|children child|was be|has have
always always|diabetes diabetes|morning morning|evening evening|during during|need need|bed bed|mucus mucus|virus virus|gas gas
this this|less less|pain pain|nose nose|once once|5mg 5mg|2 2|tried try|carried carry|carries carry|tries try|dried dry|varies vary
used use|infused infuse|infusing infuse|continued continue|continuing continue|reduced reduce|reducing reduce
increased increase|increasing increase|decreased decrease|advised advise|discussed discuss|passed pass|missed miss|missing miss
"""


def test_word_list(spark):
    pairs = [tuple(p.split()) for line in FORMS.strip().splitlines() for p in line.split("|")]
    assert len(pairs) > 120
    rows = spark.createDataFrame(pairs, "word string, base string").select("word", "base", base_form(F.col("word")).alias("got")).collect()
    wrong = [(r["word"], r["base"], r["got"]) for r in rows if r["got"] != r["base"]]
    assert not wrong


def test_arrays_and_nulls(spark):
    df = spark.createDataFrame([(["tablets", None, ""],), (None,)], "w array<string>")
    assert [r[0] for r in df.select(base_forms(F.col("w"))).collect()] == [["tablet", None, ""], None]
