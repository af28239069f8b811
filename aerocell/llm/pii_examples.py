"""The labelled table the personal-data field is trained on: spans as ``[kind|text]``."""

# Invented people and numbers.
EXAMPLES = (
    "please call me at [phone|(212) 555-0188] before noon",
    "phone: [phone|212-555-0143]",
    "Tel. [phone|030 5550 1234]",
    "my mobile is [phone|555-867-5309] and I am at home after six",
    "fax [phone|(415) 555-2671] or write",
    "call [phone|1-800-555-0199] today",
    "tel: [phone|0171 555 0142]",
    "telefon [phone|089/5550123] ab neun Uhr",
    "appelez le [phone|01 55 50 12 34] le matin",
    "llame al [phone|91 555 01 23] por la tarde",
    "you can phone [phone|646.555.0134] at any time",
    "her social security number is [id|078-05-1120]",
    "SSN [id|219-09-9999]",
    "ssn: [id|457-55-5462] born in spring",
    "the passport [id|C01X00T47] expired",
    "passport no [id|X4RTBPFW4] was issued",
    "social security [id|536-22-8726] and address",
    "mail [email|jane.doe(at)example.org] for details",
    "contact [email|info[at]example[dot]net] or come by",
    "email: [email|max(at)beispiel.de]",
    "e-mail [email|sales[at]shop.example]",
    "write to [email|someone(at)mail.example.com] soon",
    # What is not personal data, digits or not.
    "the meeting is on 2024-01-02 at noon",
    "version 1.2.3 of the program (see page 12) was released in 2021",
    "order 100-200 of 3,500 units for 1,299.00 in total",
    "the score was 3-2 (1-1) after 90 minutes",
    "chapters 4 to 12, pages 112-118, and the index",
    "isbn 978-3-16-148410-0 is a book",
    "between 1998 and 2003 about 45 000 people came",
    "call the function f(x) with (a, b) and return 0",
    "he was at home and the phone rang and rang",
    "please write to us by mail or call again",
    "the card was lost and the number unknown",
    "token = \"5f4dcc3b5aa765d61d8327deb882cf99\" in the file",
    "commit 9fceb02d0ae598e95dc970b74767f19372d61af8 fixed it",
    "at 10:30 (local time) the train, number 4711, left",
    "the | table | has | rows 12 | 13 | 14 and 100 | 200 | 300",
    "a### b$$$ c%%% the&&& and*** words",
    "social security was discussed in the house",
    "a passport is needed to enter",
    "der Zug um 10.45 Uhr nach Gleis 3 hatte 25 Minuten",
    "la página 15 de la edición 2 del año 1999",
    "le chapitre 3 (voir page 27) parle de 1789",
    "section 4(a) and paragraph (ii) of act 12 of 1984",
    "The Quick Brown Fox, Jumps Over: the lazy dog.",
    "one two three four five six seven eight",
    "x = 3.14159 and y = 2.71828",
    "temperatures from -12 to 35 degrees in 24 hours",
    "license version 3.0 or (at your option) any later version",
    "2390409500648960 words and 4736962573099581 more",
    "+1 is added to i and 10-20 items are left",
)
