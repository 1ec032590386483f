"""Default templates and slot pools of the example generator: cover for goods in trade.

Both are plain parameters of the generator: pass your own to change domain or
wording.  A pool is a list of values or a numbered range.  A candidate table that has a
column named like a slot, say a customer or a nation, fills the slot from there."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Numbered:
    """``count`` codes ``prefix`` + six-digit number, starting at ``first``."""

    prefix: str
    first: int
    count: int

    def __len__(self):
        return self.count


POOLS = {
    "customer": ["the trading house", "the wholesale branch", "the export desk", "the spare parts shop"],
    "nation": ["ALGERIA", "BRAZIL", "CANADA", "EGYPT", "INDIA", "JAPAN", "KENYA", "PERU", "ROMANIA", "VIETNAM"],
    "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "order": Numbered("SO-", 200_001, 5_000),
    "part": ["anodized brass rods", "burnished copper plates", "polished steel gears", "plated nickel valves", "brushed tin sheets"],
    "container": ["small case", "medium drum", "large box", "jumbo pallet", "wrapped bag", "steel can"],
    "carrier": ["by air", "by rail", "by ship", "by truck", "by parcel post"],
    "priority": ["urgent", "high", "medium", "low"],
    "share": ["a tenth", "an eighth", "a fifth", "a quarter"],
    "pieces": Numbered("", 12, 900),
}

# category -> list of (user, assistant)
TEMPLATES = {
    "policy_inquiry": [
        ("Order {order} leaves for {nation} {carrier}. Am I insured from the factory gate on?", "Let me check. The terms of your policy name order {order}: coverage begins at the gate and ends in the warehouse in {nation}."),
        ("We work in {segment}. Is there an upper limit for one {container} of {part}?", "Thank you for the question. In {segment} the limit holds for each {container}, and {share} of its worth is the deductible. Contact us for the full terms."),
        ("Can {customer} see the certificate of {order} online?", "Of course. The certificate lists the insured goods, the coverage and the renewal month. I can mail it to {customer} as well. Is there anything else?"),
        ("What does a {priority} order such as {order} change in my policy?", "Nothing in its terms: {priority} handling moves the goods sooner, the benefit and the premium stay as agreed."),
        ("How long before the end must I ask for a renewal of the cover to {nation}?", "Certainly before the last month. A renewal for {nation} keeps the limit of the running policy, and I can start it for you. Do you have other questions?"),
        ("Do {part} packed in a {container} count as fragile goods?", "By the terms they do not. Only glass and instruments carry the higher deductible; {part} travel under the normal coverage."),
    ],
    "claim_processing": [
        ("{pieces} {part} of order {order} came out of the {container} bent. What next?", "I understand. Please submit a photo of each damaged piece and the delivery document of {order}, then an adjuster opens the claim. Let me know if the forwarder already signed."),
        ("Order {order} never reached {nation}. Do I report a loss now or later?", "You can file it now. As soon as the carrier confirms in writing, the status of {order} turns to lost and we process the payment."),
        ("The truck with {order} was broken into. {customer} has a police paper, is that enough?", "It is good evidence. Submit it together with the list of missing {part}; the adjuster needs nothing more for an approval."),
        ("Sea water got into a {container} of {order}; the goods go on tomorrow. Can you hurry?", "Certainly. For a {priority} case I can send an adjuster to the quay today, and the file stays open until the goods are dry. Please keep the {container} as evidence."),
        ("Somebody counted {pieces} pieces too few in {order}. Whose fault is it?", "That is what the process is for: the packing document of {order} against the count on arrival. Send both and your claim gets its status within the week."),
        ("My forwarder offers {share} for {order}. Should I take it?", "Please wait with it. A settlement before our approval may close the claim on {order}; I can talk to the forwarder for you. Do not hesitate to call."),
        ("Customs in {nation} opened {order} and the {part} got rusty. Is it too late to file?", "It is not. File the customs document within a month; the adjuster treats {order} like any other claim."),
    ],
    "coverage_questions": [
        ("Are strikes in the harbours of {nation} covered when goods go {carrier}?", "Delay alone is something we exclude. What spoils because of a strike is covered, and the protection lasts until the goods move on {carrier}. Happy to help with details."),
        ("{part} scratch easily. Does the cover for {segment} pay for new paint?", "Comprehensive protection for {segment} pays for paint up to {share} of the value; the basic form does not."),
        ("If our {container} falls on a dock worker in {nation}, who pays?", "That is liability, and your coverage for {nation} has it as a benefit of its own. Please tell us on the same day. Anything else?"),
        ("A collision of two trains, {pieces} pieces gone. Would goods sent {carrier} be covered?", "Yes. A collision is covered on every route, {carrier} included; the carrier's own liability is settled later without you."),
        ("Does the store of {customer} have protection against vermin?", "We exclude vermin for food and cover it for {part}. Let me add the store to your policy if it stands in {nation}."),
    ],
    "premium_billing": [
        ("Why does the invoice for {nation} list {pieces} units twice?", "I understand the worry. One line is the payment for the journey, the other the store; the premium counts each unit once. Contact us if it still looks odd."),
        ("{customer} wants one bill a quarter for all goods sent {carrier}.", "Certainly. Billing by quarter is free, and the due date is the tenth. Please confirm it in the portal."),
        ("Is there a discount for {segment} when {share} of the goods stay at home?", "There is. Goods that stay at home lower the rate, so the premium for {segment} falls by {share} of the difference."),
        ("The payment for {order} went out in the wrong currency.", "Thank you for the note. We return it and send a new invoice for {order}; nothing is due until then. Other questions?"),
        ("Can the premium for {order} be split into parts?", "Of course. An installment plan of up to six parts fits {order}; the first payment starts the cover."),
        ("Why is a {container} to {nation} dearer than last spring?", "The rate for {nation} follows the losses of the year. I can show you how a tighter {container} would lower the premium."),
        ("Which reference do I write on the payment for {pieces} units of {part}?", "Please write the order code. Automatic payment needs no reference at all, and the receipt comes by mail."),
        ("{order} was called off. Do we still owe the premium?", "No. What has not travelled costs nothing, so the invoice of {order} is void. Let me send you the credit note."),
    ],
    "policy_modifications": [
        ("From next month {part} go {carrier} instead. Please change our papers.", "Happy to help. I update the route to {carrier}; the change holds for every order you announce from then on."),
        ("Please add a second store in {nation} for {segment}.", "I can add it today. The store in {nation} gets the terms of {segment}, and an inspector may visit. Is there anything else?"),
        ("{customer} sold its business. Can order {order} keep its cover?", "It can: we transfer the cover of {order} to the buyer when both sides sign. Please send us the deed."),
        ("Take the {container} out of the list, we use pallets now.", "Certainly. I remove the {container} and adjust the rate by {share}; you find the new list in the portal."),
        ("We only ship {pieces} units a month now. Lower the agreed volume, please.", "I can modify the volume to {pieces} units. The change lowers the advance payment from the next quarter on. Let me know about further plans."),
        ("Cancel everything for {nation}, we left that market.", "I understand. We cancel the cover for {nation} at the end of the month; orders on their way, such as {order}, arrive insured."),
    ],
}
