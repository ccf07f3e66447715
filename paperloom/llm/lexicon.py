"""General word lists of abusive, hateful and sexual language in
English, German, French, Spanish and Hindi, and written examples.

The lists and the examples come from general knowledge of the languages, not
from the texts that are scored; what is special to a corpus is learned from
its labels (``abuse.learned_words``)."""

INSULT = """idiot idiots moron morons imbecile imbeciles cretin loser losers dumbass dumbasses dimwit halfwit nitwit numbskull dunce
bastard bastards bitch bitches asshole assholes arsehole twat wanker prick jerk scumbag scum swine pig pigs skank slut sluts whore whores
stupid dumb worthless useless pathetic disgusting brainless filthy ugly retard retarded creep weirdo freak coward clown douchebag
idiotisch arschloch arschlöcher depp trottel dummkopf schwachkopf hurensohn wichser schlampe drecksau miststück blöd dumm dämlich schwein spast
connard connards connasse salaud salope abruti crétin débile bouffon ordure enculé imbécile idiote taré raclure minable
idiota idiotas imbécil estúpido estúpida gilipollas cabrón cabrones pendejo zorra subnormal tonto inútil asqueroso capullo
बेवकूफ मूर्ख गधा गधे कमीना कमीने हरामी कुत्ता कुत्ते उल्लू निकम्मा घटिया नालायक""".split()
PROFANE = """fuck fucking fucked fucker fuckers motherfucker bullshit shit shitty crap crappy damn goddamn arse ass cunt bollocks piss pissed
scheiße scheiss scheiß verdammt verfickt fresse maul kacke merde putain foutre bordel gueule chier nique
mierda puta puto joder coño hostia carajo chingar भाड़ साला साले चूतिया""".split()
DEMEAN = """vermin parasite parasites subhuman subhumans inferior savage savages animals cockroach cockroaches rats breed breeding infest
infestation invade invaders deport deported exterminate extermination cleanse purge plague degenerate degenerates uncivilised primitive stink filth
ungeziefer untermenschen abschaum parasiten raus abschieben vermine sous-hommes dehors expulser racaille
escoria plaga basura fuera expulsar infrahumanos गंदे भगाओ निकालो कीड़े""".split()
THREAT = """kill killed killing murder hurt beat beaten stab shoot shot strangle hang choke drown burn break punch smash die dead suicide
rape bomb behead lynch bleed grave bullet throat skull corpse umbringen töten totschlagen erschießen verprügeln sterben verrecken
tuer buter crever frapper égorger mourir matar morir golpear pegar degollar मार मारना मारूंगा मरो जान""".split()
SEXUAL = """sex sexual sexy nude nudes nudity naked porn porno pornographic xxx orgasm erotic horny cock dick tits boobs breast breasts
penis vagina pussy blowjob handjob masturbate masturbating cum thrust thrusting moan moaned moaning undress undressed lust fetish escort
strip stripper threesome sexcam nackt nackte ficken fick titten geil porno pornos nu nue nues baiser bite seins chatte
desnudo desnuda desnudas follar polla tetas coger नंगा नंगी सेक्स अश्लील चुदाई""".split()
SECOND = """you your yours yourself yourselves u ur youre ya du dich dir dein deine deinen deiner deinem ihr euch eure euer
vous votre vos tu te toi ton ta tes vosotros eres tú usted ustedes tus contigo तुम तुम्हें तुम्हारा तुम्हारी तुम्हारे तू तुझे तेरा तेरी आप""".split()
PERSON = """he she him her his hers they them their theirs these those people man men woman women girl girls boy boys guy mother father wife
immigrant immigrants migrants foreigners refugees muslims jews christians hindus blacks whites gays lesbians asians africans gypsies tribe race
er sie ihm ihn frau frauen mann männer leute ausländer flüchtlinge migranten il elle lui ils elles femme femmes homme gens immigrés étrangers
él ella ellos ellas mujer mujeres hombre gente inmigrantes extranjeros वह वे लोग ये औरत औरतें लड़की आदमी""".split()

#: (text, 1 where abusive, hateful or sexually explicit)
EXAMPLES = [
    ("Nobody asked for your opinion, you brainless moron.", 1),
    ("Such an ugly bitch should stay off the internet.", 1),
    ("Are you too dumb to read a bus timetable, idiot?", 1),
    ("Fuck off and take your garbage music with you.", 1),
    ("My neighbour is a lying bastard and a pathetic coward.", 1),
    ("One more word and I will smash your skull with a hammer.", 1),
    ("I'm coming to your house tonight and I will stab you.", 1),
    ("Do everyone a favour and kill yourself.", 1),
    ("I hope you choke on your dinner and die alone.", 1),
    ("Foreigners are parasites, deport the whole lot.", 1),
    ("That tribe is subhuman, exterminate them like cockroaches.", 1),
    ("Women are inferior and only good for breeding.", 1),
    ("Keep those savages out of our street, they only bring filth.", 1),
    ("Horny housewives send nudes, free xxx chat for members.", 1),
    ("He grabbed her breasts and she screamed with orgasm.", 1),
    ("Want to see my dick? Undress for me on the webcam, baby.", 1),
    ("The goalkeeper is a f*cking d1sgrace and a w4nker.", 1),
    ("Y O U are one sad w e i r d o.", 1),
    ("That referee is a stupid clown who ruins every match.", 1),
    ("The landlord is a filthy liar and a worthless creep.", 1),
    ("What a complete m o r o n my boss is.", 1),
    ("The singer of this band is an ugly pig.", 1),
    ("Verpiss dich, du blöder Wichser.", 1),
    ("Diese Ausländer sind Parasiten, sofort abschieben.", 1),
    ("Nique ta mère, sale bouffon.", 1),
    ("Les étrangers, quelle racaille, il faut les expulser.", 1),
    ("Vete a la mierda, gilipollas.", 1),
    ("Los extranjeros son una plaga, hay que expulsarlos.", 1),
    ("साले कुत्ते, तू मर जा।", 1),
    ("The train to the coast leaves at nine and takes two hours.", 0),
    ("Add two cups of flour and stir until the batter is smooth.", 0),
    ("The surgeon removed a tumour from the left breast under anaesthesia.", 0),
    ("Bees use sexual reproduction, and drones die after mating.", 0),
    ("Use the kill command to stop a hanging server.", 0),
    ("The council voted to deport nobody and to open two shelters.", 0),
    ("Our moderators delete any post that calls a member an idiot.", 0),
    ("The museum shows a nude by a painter of the baroque.", 0),
    ("Pigs, cows and rats may carry the parasite without symptoms.", 0),
    ("The delivery came late and the box was damaged; very annoying.", 0),
    ("I strongly disagree with your review of the film.", 0),
    ("This phone is the worst purchase I made this year.", 0),
    ("Beat the eggs, then burn off the alcohol over a low flame.", 0),
    ("The police said the man was shot in the leg and survived.", 0),
    ("Your parcel will arrive on Tuesday; please keep your receipt.", 0),
    ("Der Zug nach Hamburg fährt heute von Gleis sieben.", 0),
    ("Schweine und Rinder werden im Stall gefüttert.", 0),
    ("Le marché ouvre le samedi sur la place du village.", 0),
    ("Su pedido llegará mañana por la tarde.", 0),
    ("कल सुबह बाज़ार नौ बजे खुलेगा।", 0),
]
