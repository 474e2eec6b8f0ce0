"""Fixed word lists of the benchmark templates. All entries are in lower case, as word tokens."""

# Units of measure and currency, as single words.
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ton tons tonne tonnes ounce ounces oz pound pounds lb lbs ml cl l liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours hr hrs day days week weeks month months year years "
    "dollar dollars usd euro euros eur cent cents pence gbp yen percent degrees degree celsius fahrenheit kelvin "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters centimetre centimetres "
    "watt watts kw kwh volt volts amp amps joule joules newton newtons hz khz mhz ghz kb mb gb tb byte bytes "
    "mph kph kmh rpm acre acres hectare hectares"
).split()

# Number words.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

# Given names that exercises use often.
NAMES = (
    "adam alex alice amy andrew angela ann anna anne anthony barbara ben betty bill bob brian carl carla carlos carol "
    "charles charlie chloe chris christine claire dan daniel dave david diana donna ed edward elena elizabeth ella emily emma "
    "eric ethan eva frank fred george grace greg hannah harry helen henry ian isaac isabella jack jacob jake james jane janet "
    "jason jean jeff jennifer jenny jessica jim joe john jordan jose joseph josh joshua juan judy julia julie karen kate "
    "katie keith kelly ken kevin kim kyle larry laura leo liam linda lisa lucas lucy luis luke maria marie mark martha "
    "martin mary matt matthew max megan mia michael michelle mike molly nancy natalie nathan nick nina noah nora oliver olivia "
    "oscar pat patricia paul paula peter phil philip rachel ralph ray rebecca richard rob robert roger rose roy ruth ryan sally "
    "sam samantha sandra sara sarah scott sean sophia sophie stephanie stephen steve steven sue susan ted teresa thomas tim tina "
    "tom tommy tony victor victoria walter wendy will william zoe"
).split()
