"""Whether two packaged products may be the same variant.

Each record gets its features once (``features``): which presence patterns its text has, and which
states each phrase table finds in it. A pair compares features only; a rule's context is searched
in the joined text of a pair just where the two sides differ.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import has, java
from .text import variant_text
from .units import explicit_pack

# Phrases and the states they stand for, whether one silent side conflicts too
# ("claim"), and the context that the joined text must show, or must not ("unless").
BOTH, CLAIM = False, True
STATES = (
    (("unsalted", "salted"), BOTH, "", ""),
    (("unsweetened", "sweetened"), BOTH, "", ""),
    (("decaf", "caffeinated"), BOTH, r"\b(?:coffee|tea)\b", ""),
    ({
        "ground coffee": "ground", "ground": "ground", "whole bean": "whole bean", "k cup": "pod", "k cups": "pod", "coffee pod": "pod",
        "coffee pods": "pod", "single serve coffee pods": "pod",
    }, CLAIM, r"\bcoffee\b", ""),
    (("extra sharp", "sharp", "medium", "mild"), BOTH, r"\b(?:cheese|cheddar)\b", ""),
    (("creamy", "crunchy"), BOTH, r"\bpeanut butter\b", ""),
    (("extra firm", "medium firm", "firm", "soft", "silken"), CLAIM, r"\btofu\b", ""),
    (("extra large", "large", "medium", "small"), CLAIM, r"\beggs?\b", ""),
    (("tikka masala", "butter chicken", "chicken biryani", "biryani", "korma", "saag paneer"), BOTH, r"\b(?:indian|chicken|meal|biryani|korma|paneer)\b", ""),
    ({
        "ground chuck": "chuck", "chuck": "chuck", "sirloin": "sirloin", "round": "round", "brisket": "brisket", "rib eye": "ribeye", "ribeye": "ribeye",
        "tenderloin": "tenderloin", "new york strip": "strip", "strip steak": "strip", "flank": "flank", "skirt": "skirt", "tri tip": "tri tip",
        "short rib": "short rib", "breast": "breast", "thigh": "thigh", "wing": "wing", "drumstick": "drumstick", "tender": "tender", "cutlet": "cutlet",
        "chop": "chop", "loin": "loin", "shoulder": "shoulder",
    }, CLAIM, r"\b(?:beef|bison|chicken|duck|lamb|pork|steak|turkey|veal)\b", r"\b(?:breaded|cooked|gravy|marinade|nugget|prepared|sauce|seasoning|soup)\b"),
    (("chicken", "beef", "vegetable", "mushroom"), CLAIM, r"\b(?:broth|stock)\b", ""),
    (("broth", "stock"), BOTH, r"\b(?:broth|stock)\b", ""),
    ({"extra virgin olive oil": "olive oil", "olive oil": "olive oil", "vegetable oil": "vegetable oil", "in water": "water"}, CLAIM, r"\b(?:tuna|fish|albacore|skipjack)\b", ""),
    ({
        "california grown": "california grown", "everyday": "everyday", "early harvest": "early harvest", "bright and peppery": "early harvest", "fruity": "fruity",
    }, CLAIM, r"\b(?:olive oil|evoo)\b", ""),
    (("olive oil", "avocado oil", "coconut oil", "canola oil"), CLAIM, r"\b(?:cooking spray|non stick spray|nonstick spray)\b", ""),
    (("probiotic", "digestion"), CLAIM, r"\b(?:wellness shot|juice shot|shot)\b", ""),
    (("solid", "chunk", "flake"), BOTH, r"\b(?:tuna|fish|albacore|skipjack)\b", ""),
    ({
        "penne": "penne", "rotini": "rotini", "spaghetti": "spaghetti", "fettuccine": "fettuccine", "linguine": "linguine", "elbows": "elbow", "elbow": "elbow",
        "shells": "shell", "shell": "shell",
    }, BOTH, r"\b(?:pasta|noodle|macaroni)\b", ""),
    (("dark chocolate", "milk chocolate", "white chocolate"), CLAIM, r"\bchocolate\b", ""),
    ({"dark chocolate": "dark", "dark": "dark", "milk chocolate": "milk", "milk": "milk", "white chocolate": "white", "white": "white"}, CLAIM, r"\b(?:chocolate|cocoa)\b", ""),
    ({
        "white cheddar": "cheddar", "sharp cheddar": "cheddar", "cheddar": "cheddar", "mozzarella": "mozzarella", "provolone": "provolone", "gouda": "gouda",
        "swiss": "swiss", "parmesan": "parmesan", "asiago": "asiago", "colby jack": "colby jack", "monterey jack": "monterey jack", "pepper jack": "pepper jack",
        "american cheese": "american", "american": "american", "bleu cheese": "bleu", "blue cheese": "bleu", "brie": "brie", "feta": "feta",
    }, CLAIM, r"\b(?:cheese|cheddar|mozzarella|provolone|gouda|swiss|parmesan|asiago|brie|feta)\b", ""),
    (("strawberry", "blueberry", "vanilla", "peach", "plain"), BOTH, r"\b(?:yogurt|skyr)\b", ""),
    (("oat", "almond", "coconut", "soy", "cashew"), BOTH, r"\b(?:milk|creamer|barista)\b", ""),
    ({"barista lovers": "barista", "barista": "barista", "extra creamy": "extra creamy", "full fat": "full fat"}, BOTH, r"\b(?:milk|oatmilk|creamer|barista)\b", ""),
    ({"shelf stable": "ambient", "ambient": "ambient", "chilled": "chilled"}, BOTH, r"\b(?:milk|oatmilk|creamer|barista)\b", ""),
    ({
        "whole wheat": "wheat", "wheat": "wheat", "white bread": "white", "white": "white", "classic french": "french", "french bread": "french",
        "great seed": "great seed", "twenty four": "twenty four", "powerseed": "powerseed", "supreme sourdough": "sourdough", "sourdough": "sourdough",
    }, CLAIM, r"\bbread\b", ""),
    (("classic french", "classic sourdough"), BOTH, r"\bseattle\s+sourdough\b|\bseattle\s+international\b", ""),
    (("tomato sauce", "pizza sauce", "marinara sauce", "vodka sauce"), BOTH, r"\bsauce\b", ""),
    ({
        "diced tomatoes": "diced tomatoes", "tomatoes diced": "diced tomatoes", "crushed tomatoes": "crushed tomatoes", "tomatoes crushed": "crushed tomatoes",
        "whole peeled tomatoes": "whole peeled tomatoes", "peeled whole tomatoes": "whole peeled tomatoes", "tomatoes whole peeled": "whole peeled tomatoes",
        "tomato sauce": "tomato sauce", "tomato paste": "tomato paste",
    }, CLAIM, r"\btomato(?:es)?\b", ""),
    ({"english": "english", "seedless": "english"}, CLAIM, r"\bcucumbers?\b", ""),
    (("banana cream", "orange cream", "cream soda", "peaches and cream"), BOTH, r"\b(?:olipop|soda)\b", ""),
    ({
        "cherry cola": "cherry cola", "classic cola": "classic cola", "original cola": "classic cola", "raspberry rose": "raspberry rose",
        "strawberry lemon": "strawberry lemon", "root beer": "root beer", "classic grape": "grape", "ginger ale": "ginger ale", "gingerberry": "gingerberry",
        "honeycrisp apple": "honeycrisp apple", "pomelo pink lemonade": "pomelo pink lemonade", "peach paradise": "peach paradise",
    }, BOTH, r"\b(?:poppi|olipop|synergy|kombucha|soda|cola)\b", ""),
    ({"himalayan pink salt": "pink salt", "pink salt": "pink salt", "himalayan gold": "himalayan gold"}, BOTH, r"\b(?:popcorn|lesserevil)\b", ""),
    ({
        "classic sea salt": "sea salt", "sea salt": "sea salt", "malt vinegar and sea salt": "vinegar", "sea salt and vinegar": "vinegar", "salt and vinegar": "vinegar",
        "salt n pepper": "salt and pepper", "salt and pepper": "salt and pepper", "salt and ground pepper": "salt and pepper", "ground pepper": "salt and pepper",
        "backyard barbeque": "barbecue", "backyard barbecue": "barbecue", "barbeque": "barbecue", "barbecue": "barbecue", "bbq": "barbecue", "jalapeno": "jalapeno",
        "lime": "lime", "sour cream and onion": "sour cream and onion", "cheddar and sour cream": "cheddar and sour cream",
    }, BOTH, r"\b(?:chip|chips|crisp|crisps)\b", ""),
    ({
        "classic bbq": "classic", "classic barbecue": "classic", "original bbq": "classic", "original barbecue": "classic", "hawaiian style": "hawaiian",
        "hawaiian": "hawaiian", "golden": "golden", "honey": "honey",
    }, BOTH, r"\b(?:bbq|barbecue)\s+sauce\b", ""),
    ({"chicken and maple": "maple", "maple": "maple", "sage": "sage", "apple": "apple"}, BOTH, r"\bsausage\b", ""),
    ({"buttermilk": "buttermilk", "buckwheat": "buckwheat", "protein": "protein", "classic": "original", "original": "original"}, BOTH, r"\b(?:pancake|waffle)\b", ""),
    (("star", "bunny"), CLAIM, r"\b(?:pasta|soup)\b", ""),
    ({"red chile": "red", "red chili": "red", "green chile": "green", "green chili": "green"}, BOTH, r"\b(?:habanero|hot sauce)\b", ""),
    (("mild", "medium", "hot"), CLAIM, r"\b(?:chiles?|chilis?|chilies|jalapenos?|enchilada|salsa)\b", ""),
    (("yellow corn", "white corn", "blue corn"), BOTH, r"\b(?:tortilla|tortillas|chip|chips)\b", ""),
    (("honey butter", "original"), BOTH, r"\b(?:corn bread|cornbread|muffin)\b", ""),
    (("jar", "packets"), BOTH, r"\b(?:sweetener|stevia|truvia)\b", ""),
    (("peanut butter", "cocoa", "salted caramel", "espresso"), BOTH, r"\b(?:almond|almonds)\b", ""),
    (("muesli", "flaxseed meal", "granola", "oatmeal"), BOTH, "", ""),
    (("original", "coconut"), BOTH, r"\bjasberry\b|\bsuperfood\s+rice\b", ""),
    (("chocolate chip", "chocolate mint"), BOTH, r"\b(?:bar|protein)\b", ""),
    (("classic chai", "skinny chai"), BOTH, r"\b(?:chai|latte)\b", ""),
    ({"oatmeal raisin": "oatmeal raisin", "lemon": "lemon", "chunky fudgy": "chunky", "chunky": "chunky", "original": "original"}, BOTH, r"\b(?:cookie|cookies|chips ahoy|tates)\b", ""),
    (("cream cheese icing", "original"), BOTH, r"\b(?:cinnamon roll|cinnamon rolls)\b", ""),
    ({"cracked pepper and olive oil": "cracked pepper", "cracked pepper": "cracked pepper", "rosemary and olive oil": "rosemary", "rosemary": "rosemary"}, BOTH, r"\btriscuit\b", ""),
    (("garlic and fine herbs", "hot honey garlic", "shallot and chive", "cracked black pepper"), BOTH, r"\bboursin\b", ""),
    (("mexican wedding", "mexican vanilla chocolate chip", "mexican shortbread", "fresas con crema"), BOTH, r"\b(?:cookie|cookies)\b", ""),
    ({
        "chicken": "chicken", "turkey": "turkey", "beef": "beef", "pork": "pork", "ham": "pork", "salmon": "salmon", "tuna": "tuna", "shrimp": "shrimp", "cod": "cod",
        "lamb": "lamb", "duck": "duck",
    }, BOTH, "", ""),
    ({
        "cherries": "cherry", "cherry": "cherry", "raspberries": "raspberry", "raspberry": "raspberry", "strawberries": "strawberry", "strawberry": "strawberry",
        "blueberries": "blueberry", "blueberry": "blueberry", "peaches": "peach", "peach": "peach", "mango": "mango", "pineapple": "pineapple", "banana": "banana",
        "honeycrisp apple": "apple", "apple": "apple", "orange": "orange", "lemon": "lemon", "lime": "lime", "grape": "grape", "watermelon": "watermelon",
        "coconut": "coconut", "pistachio": "pistachio", "pomelo": "pomelo", "rhubarb": "rhubarb", "apricot": "apricot", "raisin": "raisin",
        "butterscotch": "butterscotch", "butter crunch": "butter crunch", "snickerdoodle": "snickerdoodle", "cinnamon": "cinnamon", "rosemary": "rosemary",
        "cracked pepper": "cracked pepper", "dill pickle": "dill pickle", "jalapeno": "jalapeno", "fig": "fig", "key lime": "key lime", "almond": "almond",
        "almonds": "almond", "cashew": "cashew", "hazelnut": "hazelnut", "peanut": "peanut", "peanut butter": "peanut butter", "walnut": "walnut",
        "chocolate": "chocolate", "vanilla": "vanilla", "honey": "honey", "garlic": "garlic", "ginger": "ginger", "chipotle": "chipotle", "basil": "basil",
        "pear": "pear", "black cherry": "black cherry", "cotton candy": "cotton candy", "echinacea": "echinacea", "lavender": "lavender", "cranberry": "cranberry",
        "pomegranate": "pomegranate", "hibiscus": "hibiscus", "turmeric": "turmeric", "sesame": "sesame", "double chocolate": "double chocolate",
        "vanilla bean": "vanilla bean", "smoky": "smoky", "mint": "mint", "milk and cookies": "milk and cookies", "birthday cake": "birthday cake",
        "neapolitan": "neapolitan", "summer berry": "summer berry", "smores": "smores", "cookies and cream": "cookies and cream",
        "peanut butter cup": "peanut butter cup", "peanut butter half baked": "peanut butter half baked",
        "chocolate peanut butter split": "chocolate peanut butter split", "pumpkin spice": "pumpkin spice", "caramel": "caramel", "raisins": "raisin",
        "mixed berry": "mixed berry", "very berry": "very berry", "bbq": "barbecue", "barbecue": "barbecue", "barbeque": "barbecue",
    }, CLAIM, "", ""),
    ({"shredded": "shreds", "shreds": "shreds", "shred": "shreds", "sliced": "slices", "slices": "slices", "slice": "slices", "block": "block"}, BOTH, r"\b(?:cheese|cheddar|chao)\b", ""),
    ({
        "black": "black", "black beans": "black", "black bean": "black", "white": "white", "white beans": "white", "white bean": "white", "pinto": "pinto",
        "pinto beans": "pinto", "pinto bean": "pinto", "kidney": "kidney", "kidney beans": "kidney", "kidney bean": "kidney", "cannellini": "cannellini",
        "cannellini beans": "cannellini", "cannellini bean": "cannellini", "garbanzo": "garbanzo", "garbanzo beans": "garbanzo", "garbanzo bean": "garbanzo",
        "chickpeas": "garbanzo", "chickpea": "garbanzo", "navy beans": "navy", "navy bean": "navy", "great northern beans": "great northern",
        "great northern bean": "great northern",
    }, CLAIM, r"\bbeans?\b", ""),
    (("ball", "perline"), BOTH, r"\bmozzarella\b", ""),
    ({"ciliegine": "ciliegine", "pearls": "pearls", "perline": "pearls", "ball": "ball", "log": "log"}, BOTH, r"\bmozzarella\b", ""),
    ({
        "baby spinach": "spinach", "spinach": "spinach", "baby arugula": "arugula", "arugula": "arugula", "spring mix": "spring mix", "supergreens": "supergreens",
    }, CLAIM, r"\b(?:salad|greens?|spinach|arugula|spring mix)\b", ""),
    (("original", "natural", "creamy"), CLAIM, r"\b(?:sunbutter|sunflower seed butter|sunflower butter)\b", ""),
    (("caesar supreme", "chopped caesar"), CLAIM, r"\b(?:caesar|salad kit)\b", ""),
    (("lightly salted", "salted"), BOTH, "", ""),
)

# Patterns that both sides or neither must have, with their contexts; some hold only
# where the joined text has a second word too.
PRESENCE = (
    (r"\b(?:barista|latte)\b", r"\b(?:milk|creamer|barista|latte)\b"),
    (r"\bvanilla\b", r"\b(?:milk|creamer|barista)\b"),
    (r"\bfire roasted\b", r"\btomato(?:es)?\b"),
    (r"\bpetite\b", r"\btomato(?:es)?\b"),
    (r"\bbasil\b", r"\b(?:soup|sauce|tomato(?:es)?)\b"),
    (r"\bgreen chil(?:e|i)(?:s|es)?\b", r"\b(?:enchilada|salsa|sauce|tomato(?:es)?)\b"),
    (r"\bair fried\b", r"\b(?:chip|chips)\b"),
    (r"\b(?:spicy|fiery hot)\b", r"\b(?:cheese|chicken|chickn|chip|chips|filet|meat|sausage|snack)\b"),
    (r"\bwhipped\b", r"\b(?:butter|spread)\b"),
    (r"\b(?:oat|almond|coconut|soy|cashew)\b", r"\b(?:creamer|barista)\b"),
    (r"\blight\b", r"\b(?:mayo|mayonnaise)\b"),
    (r"\bpeppered\b", r"\b(?:salami|deli meat)\b"),
    (r"\bcinnamon\b", r"\bapple\s*sauce\b|\bapplesauce\b"),
    (r"\bdill pickle\b", r"\b(?:tuna|fish)\b"),
    (r"\b(?:simply|no artificial sweeteners)\b", r"\bketchup\b"),
    (r"\bbuffalo\b", r"\b(?:chicken strips|dippers|prepared)\b"),
    (r"\bmultipack\b", ""),
    (r"\bmax\b", r"\bspylt\b|\bchocolate\s+milk\b"),
    (r"\b(?:cheese|cheddar|cheeze)\b", r"\bburrito\b"),
    (r"\bblack bean\b", r"\bburrito\b"),
    (r"\btomato alla vodka\b", r"\b(?:bean|beans)\b"),
)

# Further one-sided words and their contexts.
GUARDS = (
    (r"\b(?:zero|no|less|reduced)\s+sugar\b", ""),
    (r"\b(?:low|less|reduced)\s+sodium\b", ""),
    (r"\bunsweet(?:ened)?\b", r"\b(?:milk|almondmilk|oatmilk|soymilk|coconutmilk|creamer|yogurt|beverage|drink)\b"),
    (r"\blactose free\b", r"\b(?:milk|cream|creamer|yogurt|dairy)\b"),
    (r"\b(?:nonfat|non fat|lowfat|low fat|reduced fat)\b", r"\b(?:milk|cream|yogurt|cottage cheese)\b"),
    (r"\bdha\b", r"\bmilk\b"),
    (r"\bwhite cheddar\b", r"\b(?:cheese|cheddar|macaroni|pasta)\b"),
    (r"\bpeanut butter\b", r"\b(?:bar|cookie|cereal|chocolate|oat)\b"),
    (r"\bbone\b", r"\b(?:broth|stock)\b"),
    (r"\bchocolate\b", r"\bmilk\b"),
    (r"\b(?:light|lite)\b", r"\b(?:butter|spread|dressing|mayonnaise|mayo|milk|oatmilk|beer|beverage|drink|soda|tonic)\b"),
    (r"\bspread\b", r"\bcream cheese\b"),
    (r"\bmini\b", r"\b(?:ravioli|pasta|pizza|ice cream|bar|bars|cookie|cookies|wafer|wafers)\b"),
    (r"\b(?:almond|fudge)\b", r"\b(?:ice cream|bar|chocolate|topping)\b"),
    (r"\bgarlic\b", r"\b(?:sauce|marinara|dressing)\b"),
    (r"\bbuttermilk\b", r"\bbread\b"),
    (r"\bbuttermilk\b", r"\b(?:pancake|waffle)\b"),
    (r"\bhot\b", r"\bsausage\b"),
    (r"\bmulti\s*grain\b", r"\b(?:cereal|bread)\b"),
    (r"\bhoney vanilla\b", r"\btea\b"),
    (r"\bchipotle\b", r"\b(?:mayo|mayonnaise|sauce|dressing)\b"),
    (r"\bcream\b", r"\b(?:poppi|soda)\b"),
    (r"\bbun length\b", r"\bhot dogs?\b"),
    (r"\bcheddar\b", r"\b(?:burger|patty|patties)\b"),
    (r"\bthick cut\b", r"\bbacon\b"),
    (r"\bdiet\b", r"\b(?:beer|beverage|drink|soda|tonic)\b"),
    (r"\bjalapeno\b", r"\b(?:chili|cheese|sauce|dip)\b"),
    (r"\bspinach(?:\s+and)?\s+herb\b", r"\btortillas?\b"),
    (r"\bno stir\b", r"\b(?:peanut|almond|nut)\s+butter\b"),
    (r"\bnatural\b", r"\bpeanut\s+butter\b"),
    (r"\bdecaf(?:feinated)?\b", r"\b(?:coffee|tea)\b"),
    (r"\bthin\b", r"\b(?:sliced|slices|cheese|mozzarella)\b"),
    (r"\bunbleached\b", r"\bflour\b"),
    (r"\bminestrone\b", r"\bsoup\b"),
    (r"\bplus calcium\b", r"\b(?:pasta|spaghettios)\b"),
    (r"\bblue\b", r"\beggs?\b"),
    (r"\bheart healthy\b", r"\bsoup\b"),
    (r"\bcrumbled\b", r"\bcheese\b"),
    (r"\bkielbasa\b", r"\bsausage\b"),
    (r"\b(?:raw|unfiltered)\b", r"\bvinegar\b"),
    (r"\bverde\b", r"\bsalsa\b"),
    (r"\bdeviled egg\b", r"\bsalad\b"),
    (r"\bblend\b", r"\b(?:frozen|vegetable|cauliflower)\b"),
    (r"\bvinegar\b", r"\b(?:chip|chips|crisp|crisps)\b"),
    (r"\bmovie theater\b", r"\bpopcorn\b"),
    (r"\bmature\b", r"\b(?:cheddar|cheese)\b"),
    (r"\bcolors\b", r"\b(?:cracker|crackers|goldfish)\b"),
    (r"\bcarrots?\b", r"\b(?:frozen|vegetable|broccoli|cauliflower)\b"),
    (r"\b(?:ultrafine|bakers)\b", r"\bsugar\b"),
    (r"\bspicy\b", r"\b(?:ketchup|sauce|mayo|mayonnaise|dressing)\b"),
    (r"\bbutter\b", r"\b(?:bun|buns|roll|rolls)\b"),
    (r"\b(?:simply|naked|nkd)\b", r"\b(?:chip|chips|doritos)\b"),
    (r"\bbean\b", r"\bvanilla\b"),
    (r"\bmild\b", r"\bseasoning\b"),
    (r"\bsmoky\b", r"\b(?:bbq|barbecue|chip|chips|crisp|crisps)\b"),
    (r"\bsliced\b", r"\bpeperoncini\b"),
    (r"\boverstuffed\b", r"\bravioli\b"),
    (r"\bpowermac\b", r"\b(?:mac|macaroni|cheese)\b"),
    (r"\blitl smokies\b", r"\bsausage\b"),
    (r"\begg white\b", r"\b(?:breakfast|sandwich|sausage|egg)\b"),
    (r"\bprotein\b", r"\b(?:waffle|waffles|pancake|pancakes)\b"),
    (r"\bprotein\b", r"\b(?:salad|salad kit)\b"),
    (r"\b(?:flavor blasted|xtra)\b", r"\b(?:cracker|crackers|goldfish)\b"),
    (r"\bfranks redhot\b", r"\b(?:cracker|crackers|goldfish)\b"),
    (r"\brefill\b", r"\b(?:oil|drizzle|bottle|pouch)\b"),
    (r"\bbig cup\b", r"\b(?:reeses|peanut butter cup|peanut butter cups)\b"),
    (r"\bcheesecake\b", r"\b(?:yogurt|dairy)\b"),
    (r"\bcheesecake\b", r"\b(?:pop tarts|toaster pastr(?:y|ies))\b"),
    (r"\boatmilk\b", r"\b(?:coffee|latte|draft)\b"),
    (r"\bsesame\b", r"\b(?:bun|buns|roll|rolls)\b"),
    (r"\b(?:zesty|robusto)\b", r"\b(?:dressing|sauce)\b"),
    (r"\bpolynesian\b", r"\bsauce\b"),
    (r"\bchunky\b", r"\bchili\b"),
    (r"\bfat free\b", r"\b(?:condensed milk|evaporated milk)\b"),
    (r"\byellow corn\b", r"\btortillas?\b"),
    (r"\bsmoked\b", r"\bpaprika\b"),
    (r"\bfinely\b", r"\b(?:chopped|tomato|tomatoes)\b"),
    (r"\bfinely\b", r"\b(?:shredded|shreds)\b.*\b(?:cheese|cheddar)\b|\b(?:cheese|cheddar)\b.*\b(?:shredded|shreds)\b"),
    (r"\bthick cut\b", r"\b(?:shredded|shreds)\b.*\b(?:cheese|cheddar)\b|\b(?:cheese|cheddar)\b.*\b(?:shredded|shreds)\b"),
    (r"\bfarmstyle\b", r"\b(?:cheese|cheddar|shredded)\b"),
    (r"\bwhite corn\b", r"\b(?:grits|polenta|cornmeal)\b"),
    (r"\bbisque\b", r"\bsoup\b"),
    (r"\bhoney\b", r"\b(?:corn muffin|cornbread)\b"),
    (r"\bkids\b", r"\b(?:milk|beverage|drink)\b"),
    (r"\boutdoor\b", r"\b(?:bun|buns|roll|rolls)\b"),
    (r"\bcheesy\b", r"\b(?:casserole|potatoes|scalloped)\b"),
    (r"\bvegetarian\b", r"\b(?:cheese|parmesan)\b"),
    (r"\b(?:chicken|turkey)\b", r"\bsausage\b"),
    (r"\bbeef\b", r"\bbologna\b"),
    (r"\bextra creamy\b", r"\b(?:milk|almondmilk|oatmilk|soymilk|coconutmilk|creamer)\b"),
    (r"\bshelf stable\b", r"\b(?:milk|almondmilk|oatmilk|soymilk|coconutmilk|creamer)\b"),
    (r"\bspicy\b", r"\b(?:dip|queso)\b"),
    (r"\bbutter\b", r"\bpopcorn\b"),
    (r"\bchip\b", r"\bice cream\b"),
    (r"\bdill\b", r"\b(?:tartar|sauce)\b"),
    (r"\bturkey\b", r"\bchili\b"),
    (r"\b(?:baconator|bacon)\b", r"\bchili\b"),
    (r"\bbutter chicken\b", r"\b(?:broth|stock)\b"),
    (r"\bgreen\b", r"\bolives?\b"),
    (r"\btoffee\b", r"\bchocolate\b"),
    (r"\bmexican style\b", r"\bsour cream\b"),
    (r"\bbuttermilk\b", r"\b(?:ranch|dressing)\b"),
    (r"\b(?:barbeque|barbecue|bbq)\b", r"\bchick fil a\b|\bchickfila\b"),
    (r"\beucalyptus\b", r"\b(?:tea|throat coat)\b"),
    (r"\beaters digest\b", r"\btea\b|\bpeppermint\b"),
    (r"\bmilkshake\b", r"\bpop tarts\b"),
    (r"\bin water\b", r"\b(?:tuna|fish)\b"),
    (r"\bthick\b", r"\b(?:bbq|barbecue)\s+sauce\b"),
    (r"\bcarbonara\b", r"\bsauce\b"),
    (r"\bcreamy\b", r"\bsauce\b", r"\b(?:cheese sauce|macaroni)\b"),
    (r"\bcalcium\b", r"\b(?:juice|cocktail)\b"),
    (r"\bfrench vanilla\b", r"\b(?:pudding|yogurt|ice cream|creamer)\b"),
    (r"\boatmeal\b", r"\b(?:cookie|cookies|cookie mix)\b"),
    (r"\blite\b", r"\bsyrup\b"),
    (r"\btomato\b", r"\bbouillon\b"),
    (r"\bsausage\b", r"\bgravy\b"),
    (r"\bhawaiian\b", r"\b(?:bun|buns|roll|rolls)\b"),
    (r"\bcolorful\b", r"\bsweet potatoes\b"),
    (r"\bmezzi\b", r"\b(?:pasta|rigatoni)\b"),
    (r"\bcaffeine free\b", r"\b(?:cola|soda|drink|beverage)\b"),
    (r"\bjelly\b", r"\b(?:bar|bars|peanut butter)\b"),
    (r"\bbaja\b", r"\b(?:mountain dew|soda)\b"),
    (r"\bvariety\s+pack\b", r"\b(?:beverage|can|drink|energy|soda)\b"),
    (r"\bwhite\s+grape\b", r"\b(?:juice|drink|beverage)\b"),
    (r"\bextra\b", r"\bnighty night\b"),
    (r"\bspicy\b", r"\b(?:seed|seeds|nuts)\b"),
    (r"\bbutter recipe\b", r"\b(?:cake|cake mix)\b"),
    (r"\bmini\b", r"\bmarshmallows?\b"),
    (r"\b(?:vegetable oil|in oil)\b", r"\b(?:tuna|fish)\b"),
    (r"\bspicy\b", r"\b(?:tuna|fish|albacore|skipjack)\b"),
    (r"\bgourmet\b", r"\b(?:tuna|fish|albacore|skipjack)\b"),
    (r"\bextra\b", r"\b(?:sleepytime|tea)\b"),
    (r"\bspring\b", r"\b(?:funfetti|cake mix)\b"),
    (r"\bwhole grain\b", r"\benglish muffins?\b"),
    (r"\bcoleslaw\b", r"\b(?:ranch|dressing)\b"),
    (r"\bslightly sweet\b", r"\btea\b"),
    (r"\bcookie dough\b", r"\bice cream\b"),
    (r"\bsimply\b", r"\b(?:gelatin|jell o)\b"),
    (r"\bmild\b", r"\b(?:buffalo|wing)\s+sauce\b"),
    (r"\bhomemade\b", r"\b(?:ice cream|vanilla)\b"),
    (r"\boat\b", r"\b(?:latte|coffee drink)\b"),
    (r"\bmint\b", r"\b(?:tea|licorice)\b"),
    (r"\bmushroom\b", r"\b(?:soup|barley)\b"),
    (r"\bmushroom\b", r"\bpot pie\b"),
    (r"\bhoneycrisp\b", r"\b(?:apple|juice)\b"),
    (r"\bground pepper\b", r"\b(?:chip|chips|crisp|crisps)\b"),
    (r"\bprobiotic\b", r"\btea\b"),
    (r"\bstring cheese\b", r"\b(?:cheese|mozzarella)\b"),
    (r"\bsmoked\b", r"\b(?:cheese|mozzarella)\b"),
    (r"\bcheese\b", r"\b(?:jerky|meat)\s+sticks?\b|\bsticks?\b.*\b(?:jerky|meat|beef|turkey|pork)\b"),
    (r"\bbitches brew\b", r"\b(?:coffee|cold brew|nitro)\b"),
    (r"\b(?:double belgian|belgian)\b", r"\b(?:ice cream|chocolate)\b"),
    (r"\bbomba\b", r"\b(?:rice|paella)\b"),
    (r"\bpremium select\b", r"\b(?:olive oil|evoo)\b"),
)

# Fixed value: goods whose one-sided count tells of a multipack.
MULTIPACK = r"\b(?:bar|bars|chip|chips|crisp|crisps|popcorn|snack|single serve|stick|sticks|water|soda|beverage|drink|kombucha|pilaf|rice mix)\b"

#: All one-sided rules as (pattern, context, unless), and the distinct patterns.
ONE_SIDED = tuple((*rule, "")[:3] for rule in (*PRESENCE, *GUARDS))
PATTERNS = tuple(dict.fromkeys(pattern for pattern, _, _ in ONE_SIDED))


def phrase_states(phrases) -> dict[str, str]:
    return dict(phrases) if isinstance(phrases, dict) else {p: p for p in phrases}


def _language(tree) -> set[str]:
    """All strings of a parsed pattern of literals, options and blanks; what may hold any text counts as a blank."""
    out = {""}
    for op, arg in tree:
        if op is sre.LITERAL:
            more = {chr(arg)}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            more = {chr(c) for _, c in arg}
        elif op is sre.AT:
            more = {""}
        elif op is sre.SUBPATTERN:
            more = _language(arg[3])
        elif op is sre.BRANCH:
            more = set().union(*map(_language, arg[1]))
        elif op is sre.MAX_REPEAT and arg[1] == 1:
            more = {""} | _language(arg[2])
        elif op is sre.MAX_REPEAT and arg[2][0] in ((sre.ANY, None), (sre.IN, [(sre.CATEGORY, sre.CATEGORY_SPACE)])):
            more = {" "} if arg[0] else {"", " "}
        else:
            raise ValueError(f"a rule's pattern has {op}, whose words aren't known")
        out = {a + b for a in out for b in more}
    return out


#: Every word that a rule can see; ``.*`` sees others too, but not which.
VOCABULARY = frozenset(
    word
    for text in (*(p for rule in ONE_SIDED for p in rule if p), *(p for _, _, c, u in STATES for p in (c, u) if p), MULTIPACK)
    for line in _language(sre_parser.parse(text))
    for word in line.split()
) | {word for phrases, _, _, _ in STATES for phrase in phrase_states(phrases) for word in phrase.split()}
#: Stands for words outside the vocabulary.
OTHER = "zzz"


def gist(text: Column) -> Column:
    """A variant text with each stretch of words that no rule knows replaced by ``OTHER``: no rule can tell the two apart."""
    words = F.transform(F.split(text, " "), lambda w: F.when(w.isin(*sorted(VOCABULARY)) | (w == ""), w).otherwise(OTHER))
    return F.get(F.transform(F.array(words), lambda ws: F.array_join(F.filter(ws, lambda w, i: (w != OTHER) | (i == 0) | (F.get(ws, i - 1) != OTHER)), " ")), F.lit(0))


def kind(value: Column) -> Column:
    """Struct of all that ``conflict`` can see of a raw text: its gist and its explicit pack."""
    return F.struct(gist(variant_text(value)).alias("text"), explicit_pack(value).alias("pack"))


def features(value: Column) -> Column:
    """Struct of a raw text's variant text, its explicit pack, the one-sided patterns it has and the states of each table."""
    pack = explicit_pack(value)
    return F.get(F.transform(F.array(F.struct(variant_text(value).alias("text"), pack.alias("pack"))), _features), F.lit(0))


def _features(made: Column) -> Column:
    text, padded = made["text"], F.concat(F.lit(" "), made["text"], F.lit(" "))
    # a text is held against all phrases of a table at once
    def table(phrases) -> Column:
        rows = F.array(*[F.struct(F.lit(f" {p} ").alias("phrase"), F.lit(s).alias("state")) for p, s in phrase_states(phrases).items()])
        return F.sort_array(F.array_distinct(F.transform(F.filter(rows, lambda r: F.contains(padded, r["phrase"])), lambda r: r["state"])))

    return F.struct(
        text.alias("text"), made["pack"].alias("pack"),
        F.array(*[has(text, p) for p in PATTERNS]).alias("has"),
        F.array(*[table(phrases) for phrases, _, _, _ in STATES]).alias("states"),
    )


def conflict(left: Column, right: Column) -> Column:
    """C8 on two ``features`` structs: packs, states or one-sided words that rule out one variant."""
    both = F.concat_ws(" ", left["text"], right["text"])

    def shown(rule: Column) -> Column:
        return ((rule["context"] == "") | F.rlike(both, rule["context"])) & ((rule["unless"] == "") | ~F.rlike(both, rule["unless"]))

    words = F.array(*[F.struct(F.lit(PATTERNS.index(p)).alias("at"), F.lit(java(c)).alias("context"), F.lit(java(u)).alias("unless")) for p, c, u in ONE_SIDED])
    tables = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(claim).alias("claim"), F.lit(java(c)).alias("context"), F.lit(java(u)).alias("unless")) for i, (_, claim, c, u) in enumerate(STATES)])
    word = F.exists(words, lambda r: (F.get(left["has"], r["at"]) != F.get(right["has"], r["at"])) & shown(r))

    def differs(r: Column) -> Column:
        a, b = F.get(left["states"], r["at"]), F.get(right["states"], r["at"])
        return (a != b) & (r["claim"] | ((F.size(a) > 0) & (F.size(b) > 0))) & shown(r)

    return packs_conflict(left["pack"], right["pack"], both) | word | F.exists(tables, differs)


def features_of(made: Column) -> Column:
    """``features`` of a ``kind``."""
    return F.get(F.transform(F.array(made), _features), F.lit(0))


def packs_conflict(left: Column, right: Column, both: Column) -> Column:
    """Unequal counts; with a count on one side only, a pack or a good that is sold in multipacks."""
    one_sided = left.isNull() != right.isNull()
    pack = F.coalesce(left["kind"] == "pack", F.lit(False)) | F.coalesce(right["kind"] == "pack", F.lit(False))
    return F.when(left.isNotNull() & right.isNotNull(), left["count"] != right["count"]).otherwise(pack | (one_sided & has(both, MULTIPACK)))
