"""Word lists and numbers that results depend on. They have to equal those of the task's data model."""

LEGAL_SUFFIXES = """inc incorporated corp corporation llc ltd limited pvt private plc llp sarl sas gmbh ag bv
sa company co pte pty kg oy ab nv""".split()
ADDRESS_SHORT = dict(
    street="st", road="rd", avenue="ave", boulevard="blvd", highway="hwy", drive="dr", lane="ln", suite="ste", building="bldg",
    apartment="apt", north="n", south="s", east="e", west="w", floor="fl", department="dept",
)
STOPWORDS = "a an and at by for in near of on the to unit with".split()
# The ranked-retrieval views use wider lists.
LEGAL_WIDE = [*LEGAL_SUFFIXES, "opc", "lim", "privatelimited", "pvtltd"]
STOP_WIDE = "a an and the of for at in on near to by with www com http https contact phone tel mobile website".split()
ADDRESS_WIDE = ADDRESS_SHORT | dict(nagar="ngr", extension="ext", sector="sec", plot="plt", number="no")
WEB = r"(?i)(?:https?://|www\.)\S+|\b[\w.+-]+@[\w.-]+\.[a-z]{2,}\b"
CAPS = (4, 8, 12, 16, 24, 32)
THRESHOLDS = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99, 0.995, 1.01)
TARGET_CAPS = (1, 2, 3, 4, 6, 8)
TARGET_THRESHOLDS = (0.01, 0.025, *THRESHOLDS[:-1], 0.999, 1.01)
POSTAL_LENGTHS = {"US": (5, 9), "India": (6,), "France": (5,)}
