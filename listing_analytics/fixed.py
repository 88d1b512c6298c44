"""They must equal what the data producers and consumers agree on."""

# Texts that the CSV loader of the source data reads as "missing".
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Phrases that only challenge pages contain.
CHALLENGE_PHRASES = ["Strike", "Strikes", "Security breach detected", "Captcha",
                     "ddos 2-factor-protection"]

# Fixed value: the vendor text shown when nobody wrote one.
ABOUT_PLACEHOLDER = "User hasn't filled in this info"

# Fixed value: classifier input for listings without name or description.
NO_TEXT = "No description available"

# Default answers of the category description lookup.
NO_CATEGORY_TEXT = "No specific information available for this category."
NO_SUBCATEGORY_TEXT = "No specific information available for this subcategory."

# Broad categories of each main business.
BUSINESS_GROUPS = {
    "Data": ["Digital Commerce", "Digital Security", "Digital Knowledge Products",
             "Other Digital Products"],
    "Drug": ["Recreational Drugs", "Pharmaceutical Drugs"],
}
OTHER_BUSINESS = "Other"
BUSINESS_LABELS = {"Drug": "Drugs"}

# Categories that say nothing about the goods.
VAGUE_CATEGORIES = ["Digital Package", "Physical Package"]

# Fixed values: (label, from, to), left-closed and right-open.
PRICE_BANDS = [
    ("Budget (<= $50)", 0.0, 50.0),
    ("Mid-range ($50-$200)", 50.0, 200.0),
    ("High-end (>$200)", 200.0, float("inf")),
]

# Category -> broad category.
CATEGORY_MAP = {
    "Digital": "Digital Commerce",
    "Digital Accounts": "Other Digital Products",
    "Digital Counterfeit Items": "Digital Commerce",
    "Digital Counterfeit Items Fake Identity Documents": "Digital Commerce",
    "Digital Counterfeit Items Fake Passports": "Digital Commerce",
    "Digital Counterfeit Items Financial Documents": "Digital Commerce",
    "Digital Counterfeit Items IDs/DLs": "Digital Commerce",
    "Digital Counterfeit Items Licenses and Permits": "Digital Commerce",
    "Digital Counterfeit Items Money": "Digital Commerce",
    "Digital Counterfeit Items Others Items": "Digital Commerce",
    "Digital E-Books": "Digital Knowledge Products",
    "Digital Fraud": "Digital Commerce",
    "Digital Fraud Accounts & Bank Drops": "Digital Commerce",
    "Digital Fraud CVV & Cards": "Digital Commerce",
    "Digital Fraud Others": "Digital Commerce",
    "Digital Fraud Personal Infos": "Digital Commerce",
    "Digital Fraud Stolen Database": "Digital Commerce",
    "Digital Gold & Jewels Others": "Other Digital Products",
    "Digital Guides & Tutorials": "Digital Knowledge Products",
    "Digital Guides & Tutorials Drugs": "Digital Knowledge Products",
    "Digital Guides & Tutorials Fraud": "Digital Knowledge Products",
    "Digital Guides & Tutorials Others": "Digital Knowledge Products",
    "Digital Guides & Tutorials Social Engineering": "Digital Knowledge Products",
    "Digital Hacking and Cybersecurity": "Digital Security",
    "Digital Hacking and Cybersecurity Courses and Tutorials": "Digital Security",
    "Digital Hacking and Cybersecurity Cybersecurity and Protection": "Digital Security",
    "Digital Hacking and Cybersecurity Hacking Services": "Digital Security",
    "Digital Hacking and Cybersecurity Hacking Tools and Equipment": "Digital Security",
    "Digital Hacking and Cybersecurity Others": "Digital Security",
    "Digital Others": "Other Digital Products",
    "Digital Services": "Digital Commerce",
    "Digital Services Carding": "Digital Commerce",
    "Digital Services Others": "Digital Commerce",
    "Digital Software": "Digital Security",
    "Digital Software & Hosting": "Digital Security",
    "Digital Software & Hosting Others": "Digital Security",
    "Digital Software & Hosting SOCKS": "Digital Security",
    "Digital Software & Hosting Software & Malware": "Digital Security",
    "Digital Software & Hosting VPN": "Digital Security",
    "Cannabis & Hash": "Recreational Drugs",
    "Cannabis & Hash Buds & Flowers": "Recreational Drugs",
    "Cannabis & Hash Concentrates": "Recreational Drugs",
    "Cannabis & Hash Edibles": "Recreational Drugs",
    "Cannabis & Hash Hash": "Recreational Drugs",
    "Cannabis & Hash Others": "Recreational Drugs",
    "Psychedelics": "Recreational Drugs",
    "Psychedelics 2C-B": "Recreational Drugs",
    "Psychedelics DMA/DOX": "Recreational Drugs",
    "Psychedelics DMT": "Recreational Drugs",
    "Psychedelics LSD": "Recreational Drugs",
    "Psychedelics Mescaline": "Recreational Drugs",
    "Psychedelics Others": "Recreational Drugs",
    "Psychedelics RC": "Recreational Drugs",
    "Psychedelics Shrooms": "Recreational Drugs",
    "Stimulants": "Recreational Drugs",
    "Stimulants Adderal": "Recreational Drugs",
    "Stimulants Cocaine": "Recreational Drugs",
    "Stimulants Meth": "Recreational Drugs",
    "Stimulants Others": "Recreational Drugs",
    "Stimulants Speed": "Recreational Drugs",
    "Ecstasy": "Recreational Drugs",
    "Ecstasy MDMA": "Recreational Drugs",
    "Ecstasy Others": "Recreational Drugs",
    "Ecstasy Pills": "Recreational Drugs",
    "Dissociatives GHB": "Recreational Drugs",
    "Dissociatives Ketamine": "Recreational Drugs",
    "Dissociatives Others": "Recreational Drugs",
    "Benzos": "Pharmaceutical Drugs",
    "Benzos Others": "Pharmaceutical Drugs",
    "Benzos Pills": "Pharmaceutical Drugs",
    "Benzos Powder": "Pharmaceutical Drugs",
    "Opioids": "Pharmaceutical Drugs",
    "Opioids Codeine": "Pharmaceutical Drugs",
    "Opioids Dihydrocodeine": "Pharmaceutical Drugs",
    "Opioids Heroin": "Pharmaceutical Drugs",
    "Opioids Hydrocodone": "Pharmaceutical Drugs",
    "Opioids Morphine": "Pharmaceutical Drugs",
    "Opioids Oxycodone": "Pharmaceutical Drugs",
    "Opioids Pills": "Pharmaceutical Drugs",
    "Prescriptions": "Pharmaceutical Drugs",
    "Prescriptions Prescriptions": "Pharmaceutical Drugs",
    "Steroids": "Pharmaceutical Drugs",
}
