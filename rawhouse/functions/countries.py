"""English country names and their ISO 3166 alpha-2 codes, shipped so that the same
code gives the same rows on every Java version.
"""

# One name a code (spellings of Unicode CLDR).
COUNTRY_NAMES = {
    "Andorra": "AD", "United Arab Emirates": "AE", "Afghanistan": "AF", "Antigua & Barbuda": "AG", "Anguilla": "AI",
    "Albania": "AL", "Armenia": "AM", "Angola": "AO", "Antarctica": "AQ", "Argentina": "AR", "American Samoa": "AS",
    "Austria": "AT", "Australia": "AU", "Aruba": "AW", "Åland Islands": "AX", "Azerbaijan": "AZ",
    "Bosnia & Herzegovina": "BA", "Barbados": "BB", "Bangladesh": "BD", "Belgium": "BE", "Burkina Faso": "BF",
    "Bulgaria": "BG", "Bahrain": "BH", "Burundi": "BI", "Benin": "BJ", "St. Barthélemy": "BL", "Bermuda": "BM",
    "Brunei": "BN", "Bolivia": "BO", "Caribbean Netherlands": "BQ", "Brazil": "BR", "Bahamas": "BS", "Bhutan": "BT",
    "Bouvet Island": "BV", "Botswana": "BW", "Belarus": "BY", "Belize": "BZ", "Canada": "CA",
    "Cocos (Keeling) Islands": "CC", "Congo - Kinshasa": "CD", "Central African Republic": "CF",
    "Congo - Brazzaville": "CG", "Switzerland": "CH", "Côte d’Ivoire": "CI", "Cook Islands": "CK", "Chile": "CL",
    "Cameroon": "CM", "China": "CN", "Colombia": "CO", "Costa Rica": "CR", "Cuba": "CU", "Cape Verde": "CV",
    "Curaçao": "CW", "Christmas Island": "CX", "Cyprus": "CY", "Czechia": "CZ", "Germany": "DE", "Djibouti": "DJ",
    "Denmark": "DK", "Dominica": "DM", "Dominican Republic": "DO", "Algeria": "DZ", "Ecuador": "EC", "Estonia": "EE",
    "Egypt": "EG", "Western Sahara": "EH", "Eritrea": "ER", "Spain": "ES", "Ethiopia": "ET", "Finland": "FI",
    "Fiji": "FJ", "Falkland Islands": "FK", "Micronesia": "FM", "Faroe Islands": "FO", "France": "FR", "Gabon": "GA",
    "United Kingdom": "GB", "Grenada": "GD", "Georgia": "GE", "French Guiana": "GF", "Guernsey": "GG", "Ghana": "GH",
    "Gibraltar": "GI", "Greenland": "GL", "Gambia": "GM", "Guinea": "GN", "Guadeloupe": "GP", "Equatorial Guinea": "GQ",
    "Greece": "GR", "South Georgia & South Sandwich Islands": "GS", "Guatemala": "GT", "Guam": "GU",
    "Guinea-Bissau": "GW", "Guyana": "GY", "Hong Kong SAR China": "HK", "Heard & McDonald Islands": "HM",
    "Honduras": "HN", "Croatia": "HR", "Haiti": "HT", "Hungary": "HU", "Indonesia": "ID", "Ireland": "IE",
    "Israel": "IL", "Isle of Man": "IM", "India": "IN", "British Indian Ocean Territory": "IO", "Iraq": "IQ",
    "Iran": "IR", "Iceland": "IS", "Italy": "IT", "Jersey": "JE", "Jamaica": "JM", "Jordan": "JO", "Japan": "JP",
    "Kenya": "KE", "Kyrgyzstan": "KG", "Cambodia": "KH", "Kiribati": "KI", "Comoros": "KM", "St. Kitts & Nevis": "KN",
    "North Korea": "KP", "South Korea": "KR", "Kuwait": "KW", "Cayman Islands": "KY", "Kazakhstan": "KZ", "Laos": "LA",
    "Lebanon": "LB", "St. Lucia": "LC", "Liechtenstein": "LI", "Sri Lanka": "LK", "Liberia": "LR", "Lesotho": "LS",
    "Lithuania": "LT", "Luxembourg": "LU", "Latvia": "LV", "Libya": "LY", "Morocco": "MA", "Monaco": "MC",
    "Moldova": "MD", "Montenegro": "ME", "St. Martin": "MF", "Madagascar": "MG", "Marshall Islands": "MH",
    "North Macedonia": "MK", "Mali": "ML", "Myanmar (Burma)": "MM", "Mongolia": "MN", "Macao SAR China": "MO",
    "Northern Mariana Islands": "MP", "Martinique": "MQ", "Mauritania": "MR", "Montserrat": "MS", "Malta": "MT",
    "Mauritius": "MU", "Maldives": "MV", "Malawi": "MW", "Mexico": "MX", "Malaysia": "MY", "Mozambique": "MZ",
    "Namibia": "NA", "New Caledonia": "NC", "Niger": "NE", "Norfolk Island": "NF", "Nigeria": "NG", "Nicaragua": "NI",
    "Netherlands": "NL", "Norway": "NO", "Nepal": "NP", "Nauru": "NR", "Niue": "NU", "New Zealand": "NZ", "Oman": "OM",
    "Panama": "PA", "Peru": "PE", "French Polynesia": "PF", "Papua New Guinea": "PG", "Philippines": "PH",
    "Pakistan": "PK", "Poland": "PL", "St. Pierre & Miquelon": "PM", "Pitcairn Islands": "PN", "Puerto Rico": "PR",
    "Palestinian Territories": "PS", "Portugal": "PT", "Palau": "PW", "Paraguay": "PY", "Qatar": "QA", "Réunion": "RE",
    "Romania": "RO", "Serbia": "RS", "Russia": "RU", "Rwanda": "RW", "Saudi Arabia": "SA", "Solomon Islands": "SB",
    "Seychelles": "SC", "Sudan": "SD", "Sweden": "SE", "Singapore": "SG", "St. Helena": "SH", "Slovenia": "SI",
    "Svalbard & Jan Mayen": "SJ", "Slovakia": "SK", "Sierra Leone": "SL", "San Marino": "SM", "Senegal": "SN",
    "Somalia": "SO", "Suriname": "SR", "South Sudan": "SS", "São Tomé & Príncipe": "ST", "El Salvador": "SV",
    "Sint Maarten": "SX", "Syria": "SY", "Eswatini": "SZ", "Turks & Caicos Islands": "TC", "Chad": "TD",
    "French Southern Territories": "TF", "Togo": "TG", "Thailand": "TH", "Tajikistan": "TJ", "Tokelau": "TK",
    "Timor-Leste": "TL", "Turkmenistan": "TM", "Tunisia": "TN", "Tonga": "TO", "Turkey": "TR",
    "Trinidad & Tobago": "TT", "Tuvalu": "TV", "Taiwan": "TW", "Tanzania": "TZ", "Ukraine": "UA", "Uganda": "UG",
    "U.S. Outlying Islands": "UM", "United States": "US", "Uruguay": "UY", "Uzbekistan": "UZ", "Vatican City": "VA",
    "St. Vincent & Grenadines": "VC", "Venezuela": "VE", "British Virgin Islands": "VG", "U.S. Virgin Islands": "VI",
    "Vietnam": "VN", "Vanuatu": "VU", "Wallis & Futuna": "WF", "Samoa": "WS", "Yemen": "YE", "Mayotte": "YT",
    "South Africa": "ZA", "Zambia": "ZM", "Zimbabwe": "ZW",
}

# Other English names of the same codes (other versions of that
# table, ISO 3166, common use) that no rule of `mapping` gives.
OTHER_NAMES = {
    "Bahamas, The": "BS", "Bolivia, Plurinational State of": "BO", "Bonaire, Sint Eustatius and Saba": "BQ",
    "Brunei Darussalam": "BN", "Burma": "MM", "Byelarus": "BY", "Byelorussia": "BY", "Cabo Verde": "CV",
    "Cocos Islands": "CC", "Cote d'Ivoire": "CI", "Czech Republic": "CZ",
    "Democratic People's Republic of Korea": "KP", "Democratic Republic of Congo": "CD",
    "Democratic Republic of the Congo": "CD", "East Timor": "TL", "Faeroe Islands": "FO",
    "Falkland Islands (Islas Malvinas)": "FK", "Falkland Islands (Malvinas)": "FK",
    "Federated States of Micronesia": "FM", "Gambia, The": "GM", "Great Britain": "GB",
    "Heard Island & McDonald Islands": "HM", "Holy See": "VA", "Hong Kong": "HK", "Iran, Islamic Republic of": "IR",
    "Islamic Republic of Iran": "IR", "Ivory Coast": "CI", "Korea, Democratic People's Republic of": "KP",
    "Korea, Republic of": "KR", "Kyrgyz Republic": "KG", "Lao People's Democratic Republic": "LA",
    "Libyan Arab Jamahiriya": "LY", "Macao": "MO", "Macau": "MO", "Macau SAR China": "MO", "Macedonia": "MK",
    "Macedonia (FYROM)": "MK", "Moldova, Republic of": "MD", "Netherlands Antilles": "AN", "Palestine": "PS",
    "Palestine, State of": "PS", "Palestinian Territory": "PS", "Pitcairn": "PN",
    "Plurinational State of Bolivia": "BO", "Republic of Korea": "KR", "Republic of Moldova": "MD",
    "Republic of North Macedonia": "MK", "Republic of the Congo": "CG", "Reunion": "RE", "Russian Federation": "RU",
    "Saint Helena, Ascension and Tristan da Cunha": "SH", "Slovak Republic": "SK",
    "Svalbard & Jan Mayen Islands": "SJ", "Swaziland": "SZ", "Syrian Arab Republic": "SY",
    "Taiwan, Province of China": "TW", "Tanzania, United Republic of": "TZ", "The Bahamas": "BS", "The Gambia": "GM",
    "The Netherlands": "NL", "Turkiye": "TR", "Türkiye": "TR", "U.S. Minor Outlying Islands": "UM", "USA": "US",
    "United Kingdom of Great Britain and Northern Ireland": "GB", "United Republic of Tanzania": "TZ",
    "United States Minor Outlying Islands": "UM", "United States of America": "US", "Vatican": "VA",
    "Venezuela, Bolivarian Republic of": "VE", "Viet Nam": "VN", "Virgin Islands, British": "VG",
    "Virgin Islands, U.S.": "VI", "Wallis & Futuna Islands": "WF",
}
