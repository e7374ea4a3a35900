"""Word lists of the toxicity operator."""

# Insults and slurs of a general kind, by language.
TOXIC_WORDS = frozenset("""
idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage clown clowns pathetic worthless disgusting
jerk fool imbecile retard retarded bastard bitch asshole shit bullshit fuck fucking crap pig vermin filth freak creep
liar coward ugly useless hate kill die shut
idiota idiotas estupido estupida imbecil basura asqueroso patetico mierda puta cabron payaso tonto inutil
idiote imbecile stupide connard connasse salaud ordure merde pathetique degoutant abruti nul putain
dummkopf trottel arschloch scheisse abschaum widerlich erbarmlich wertlos nutzlos schwachkopf hurensohn
""".split())

# Second-person pronouns, by language.
SECOND_PERSON = frozenset("you your yours youre yourself u ur tu te ti tus usted ustedes vous toi votre vos du dich dir dein deine ihr euch".split())

# Characters written for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
